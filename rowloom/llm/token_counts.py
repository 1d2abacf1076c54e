"""Token counts by a map-side two-tier lookup.

The first tier is a compact table, broadcast: the number of tokens of the pre-tokens that are frequent in a bounded
sample of documents. The second is a cache in each worker, through which every other pre-token goes to the tokenizer
once. Neither tier decides a count, they only save work, and no pre-token is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.batches import sliced, texts
from rowloom.llm.wordbpe import MADE, Cache, encoder

#: Rows that the frequent pre-tokens are taken from, on average; how many of these are broadcast, and of how many
#: characters, at most. So the broadcast has 8 MB at most.
SAMPLE, FREQUENT, LONGEST = 2_000, 30_000, 64
#: Tasks that the sample is counted in; each gives at most FREQUENT rows to the driver.
TASKS = 16
#: Pre-tokens that each generation of a worker's cache of lengths holds at most: some 60 MB for both.
CACHED = 250_000


def frequent_lengths(docs: DataFrame, tokenizer: str, sample: int = SAMPLE, most: int = FREQUENT) -> dict[str, int]:
    """Numbers of tokens of the pre-tokens most frequent in about `sample` rows, each row drawn with the same probability.

    One scan, after the number of rows (which Parquet files tell by their footers). The rows drawn are dealt to TASKS
    tasks, which count at the same time."""
    share = min(1.0, sample / max(1, docs.count()))
    drawn = docs.select("text").sample(share, seed=7).repartition(TASKS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = encoder(tokenizer), Counter()
        for batch in sliced(batches):
            for words in map(own.pre_tokens, texts(batch.column("text"))):
                seen.update(word for word in words or () if len(word) <= LONGEST)
        words, counts = zip(*seen.most_common(most)) if seen and most else ((), ())
        sizes = list(map(len, own.encode_words(list(words))))
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["word", "n", "size"])

    counted = drawn.mapInArrow(count, "word string, n long, size long").toArrow()  # at most TASKS x most rows
    totals = counted.group_by("word").aggregate([("n", "sum"), ("size", "min")])
    top = totals.sort_by([("n_sum", "descending"), ("word", "ascending")]).slice(0, most)
    return dict(zip(top["word"].to_pylist(), top["size_min"].to_pylist()))


class Counts:
    """Numbers of tokens of texts: from the broadcast table, then the worker's own cache, then the tokenizer."""

    def __init__(self, tokenizer: str):
        self.encoder, self.cache = encoder(tokenizer), Cache(CACHED)

    def __call__(self, batch: list[str], frequent: dict[str, int]) -> list[int]:
        own, cache = self.encoder, self.cache
        split = [own.pre_tokens(text) for text in batch]
        found = [None if words is None else list(map(frequent.get, words)) for words in split]
        rest = [words and [word for word, size in zip(words, sizes) if size is None] for words, sizes in zip(split, found)]
        met = cache.known(set().union(*filter(None, rest)))
        missing = [word for word, size in met.items() if size is None]
        for start in range(0, len(missing), MADE):
            names = missing[start : start + MADE]
            for name, ids in zip(names, own.encode_words(names)):
                met[name] = len(ids)
                cache.put(name, len(ids))
        return [
            len(own.library.encode(text, add_special_tokens=False)) if sizes is None else sum(filter(None, sizes)) + sum(map(met.__getitem__, others))
            for text, sizes, others in zip(batch, found, rest)
        ]


@lru_cache(maxsize=1)
def counter(tokenizer: str) -> Counts:
    """One cache in a worker, kept from task to task."""
    return Counts(tokenizer)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, sample: int = SAMPLE, most: int = FREQUENT) -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens (without special tokens), over_limit.

    Counts are those of the tokenizers library, with its default for the strings of special tokens inside a text. A null
    or empty text has none. Null doc_ids and repeated rows are rows like others; an empty table gives an empty result.
    Columns other than doc_id and text are not looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, tokenizer, sample, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(tokenizer)
        for batch in sliced(batches, 256):
            n = counts(texts(batch.column("text")), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size, "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)

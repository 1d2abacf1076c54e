"""Importance resampling towards a target distribution of hashed n-grams.

Both passes over the texts intern the n-grams of a batch in an open-addressed numpy table (`wordbytes.Table`: XXH64 keys,
bytes compared). A slot holds its n-gram's bucket and count: the first pass adds counts up by bucket, in the second the
gain of its slot's bucket goes to each occurrence. Only bucket counts and one row of numbers per document are moved.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.tables import written
from rowloom.llm.wordbytes import WORDS, Table, Words, words_of
from rowloom.operators.index import dense_index

BUCKETS = 10_000


def ngrams(words: Words, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, begin, size) of all runs of 1 to `most` words within a text, a bounded number of words at a time."""
    text, end = words.text_of(), words.begin + words.size
    for start in range(0, len(words), WORDS):
        firsts, parts = np.arange(start, min(start + WORDS, len(words))), []
        for n in range(most):
            firsts = firsts[firsts + n < len(words)]
            firsts = firsts[text[firsts] == text[firsts + n]]
            parts.append((text[firsts], words.begin[firsts], end[firsts + n] - words.begin[firsts]))
        yield tuple(map(np.concatenate, zip(*parts)))


def interned(words: Words, most: int, buckets: int) -> Iterator[tuple[np.ndarray, Table, np.ndarray]]:
    """(text of each occurrence, table, bucket of each slot in use) of the n-grams of some texts."""
    for text, begin, size in ngrams(words, most):
        table = Table(words.buffer, begin, size)
        yield text, table, np.fromiter(map(crc32, table.strings()), np.int64, len(table.used)) % buckets


def bucket_counts(texts: DataFrame, text: str = "text", most: int = 2, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams of all texts, repeats counted, fall into each bucket. A task sends a number per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, words in words_of(batch.column(0)):
                for _, table, bucket in interned(words, most, buckets):
                    count = np.bincount(table.slot, minlength=len(table.first))[table.used]
                    total += np.bincount(bucket, count, buckets).astype(np.int64)
        pa.default_memory_pool().release_unused()
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    rows = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():  # a row per bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(share in the target / share in the source)) of each bucket, one added to each bucket's count."""
    up = (target + 1).astype(float) * float(source.sum() + len(source))
    down = (source + 1).astype(float) * float(target.sum() + len(source))
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def _weighed(docs: DataFrame, gain: np.ndarray, most: int) -> DataFrame:
    """docs (text and other columns) without text, then n_words, n_features and the sum of the features' gains."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for first, words in words_of(batch.column(0)):
                here = slice(first, first + len(words.bounds) - 1)
                n_words[here] = np.diff(words.bounds)
                k = len(words.bounds) - 1
                for text, table, bucket in interned(words, most, len(shared.value)):
                    of_slot = np.zeros(len(table.first), np.int64)
                    of_slot[table.used] = shared.value[bucket]
                    n[here] += np.bincount(text, minlength=k)
                    total[here] += np.bincount(text, of_slot[table.slot], k).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *map(pa.array, (n_words, n, total))], [*batch.schema.names[1:], "n_words", "n_features", "total"])
        pa.default_memory_pool().release_unused()

    schema = docs.drop("text").schema.add("n_words", "long").add("n_features", "long").add("total", "long")
    return docs.mapInArrow(run, schema)


def noise(doc_id: Column, seed: int) -> Column:
    """A document's Gumbel noise in thousandths, out of the hash of its id; a null id counts as no text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def importance(docs: DataFrame, target: DataFrame, share: int = 25, least_words: int = 20, most: int = 2, buckets: int = BUCKETS, seed: int = 7, keep: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_features, weight, score, rank (null: not drawn); with keep also `row`, all of the
    row's own columns as a struct.

    weight: the floored mean gain of a document's features (runs of 1 to `most` words), towards the texts of `target`;
    score: weight and noise. Of the N rows with at least least_words words the floor(share * N / 100) highest scores are
    drawn, ties to the smaller doc_id (null last; equal ones by n_features and weight). A null text has no words; repeated
    rows are rows of their own. An empty target gives every bucket the count one; an empty table gives no row.

    Ranks come from ranges of (score, doc_id) numbered by themselves, so no task sees more than its range."""
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"), *([F.struct(*docs.columns).alias("row")] if keep else []))
    gain = gains(bucket_counts(rows, most=most, buckets=buckets), bucket_counts(target, most=most, buckets=buckets))
    weight = F.when(F.col("n_features") > 0, F.expr("(total - pmod(total, n_features)) div n_features")).otherwise(F.lit(0)).cast("long")
    weighed = _weighed(rows, gain, most).withColumn("weight", weight).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = written(weighed.drop("total"), "importance")
    drawable = scored.where(F.col("n_words") >= least_words)
    drawn = drawable.count() * share // 100
    ranked = dense_index(drawable, F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "weight", name="rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    others = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    names = ["doc_id", "n_features", "weight", "score", "rank", *(["row"] if keep else [])]
    return ranked.select(*names).unionByName(others.select(*names))


def resampled(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of docs, with all their columns; options as of `importance`."""
    return importance(docs, target, keep=True, **options).where("rank IS NOT NULL").select("row.*")

"""Ranked lexical search, term at a time with limited accumulators.

Documents stay where they are. A first pass counts how many documents hold each wanted term; a second one inverts each
batch of documents in its task and answers every item from that: terms go rarest first, each with a bound of what it can
still add; documents get accumulators until the bounds of the terms left can't reach the item's k-th best score, and from
then on only those that have one are updated, exactly. What a task has found in earlier batches raises that score. A task
returns k rows for each item at most, and these are merged in two steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.tables import written
from rowloom.llm.wordbytes import WORDS, Table, of_list, words_of

#: Items, and bytes of their terms, that are answered by one pass; more make further passes over the documents.
ITEMS, TERM_BYTES = 4_096, 16 << 20
#: One whole in the fixed-point parts of a score: 1,000,000 is the most that a term's frequency can count for.
UNIT, SCALE = 1_000, 1_000_000_000
#: Tasks whose results are merged by themselves first.
MERGED = 64


def weight(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


def norm(n_terms: np.ndarray, n_docs: int, all_terms: int, slope: int) -> np.ndarray:
    """m of a document, in hundredths: longer documents than the average have more. Rounded down."""
    return 100 - slope + (slope * n_terms * n_docs) // max(1, all_terms)


class Vocabulary:
    """The wanted terms and the items that want them."""

    def __init__(self, items: list[list[bytes]]):
        self.terms = sorted(set().union(*items)) if items else []
        number = {term: i for i, term in enumerate(self.terms)}
        self.items = [np.array(sorted(map(number.get, set(item))), np.int64) for item in items]
        self.df = np.zeros(len(self.terms), np.int64)
        self.n_docs = self.all_terms = 0

    def table(self) -> Table:
        return Table(*of_list(self.terms))


def postings(column: pa.Array, table: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number of terms of each text; term, text, frequency of each posting in order of term and text)."""
    lengths, found = np.zeros(len(column), np.int64), []
    for first, words in words_of(column):
        k = len(words.bounds) - 1
        lengths[first : first + k] = np.diff(words.bounds)
        text = words.text_of() + first
        for start in range(0, len(words), WORDS):
            part = slice(start, start + WORDS)
            term = table.find(words.buffer, words.begin[part], words.size[part])
            held = term >= 0
            found.append(np.stack(np.unique(term[held] * len(column) + text[part][held], return_counts=True)))
    if not found:
        return lengths, *(np.zeros(0, np.int64) for _ in range(3))
    keys, counts = np.concatenate(found, axis=1)
    keys, place = np.unique(keys, return_inverse=True)  # a text cut into parts has its postings once
    return lengths, keys // len(column), keys % len(column), np.bincount(place, counts, len(keys)).astype(np.int64)


class Best:
    """The k best rows of an item so far: highest score, then smallest doc_id, null last."""

    def __init__(self, k: int):
        self.k, self.score, self.doc, self.null = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """The score that another row has to reach; 1 while there is room."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc, null = np.concatenate([self.score, score]), np.concatenate([self.doc, doc]), np.concatenate([self.null, null])
        order = np.lexsort((doc, null, -score))[: self.k]
        self.score, self.doc, self.null = score[order], doc[order], null[order]


def answer(item: np.ndarray, w: np.ndarray, part: np.ndarray, most: np.ndarray, first: np.ndarray, text: np.ndarray, n: int, best: Best, spare: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(texts, scores) of a batch of n texts that may be among an item's best.

    item: its terms. w: weights of all terms. Postings of term t are first[t] to first[t + 1]: text, and part, what the
    frequency counts for; most: the greatest part of each term. spare: gets the number of accumulators made."""
    terms = item[(first[item + 1] > first[item]) & (w[item] > 0)]
    terms = terms[np.lexsort((terms, -w[terms]))]  # rarest first
    bound = w[terms] * most[terms]
    rest = bound[::-1].cumsum()[::-1]  # what this term and all after it can add at most
    score, live, creating, least = np.zeros(n, np.int64), np.zeros(n, bool), True, best.least
    for term, left in zip(terms.tolist(), rest.tolist()):
        a, b = first[term], first[term + 1]
        at, gain = text[a:b], part[a:b] * w[term]
        if creating and left < least:
            creating = False
        elif creating and best.k <= n and left <= score.max():
            # partial scores only grow: the k-th of them is below the final k-th
            least = max(least, int(np.partition(score, n - best.k)[n - best.k]))
            creating = left >= least
        if creating:
            live[at] = True
        else:
            own = live[at]
            at, gain = at[own], gain[own]
        score[at] += gain  # a text has one posting of a term
    if spare is not None:
        spare.append(int(live.sum()))
    found = np.flatnonzero(live & (score >= max(1, least)))
    return found, score[found]


@lru_cache(maxsize=1)
def _table(shared) -> Table:
    """One table of the terms in a worker, kept from task to task."""
    return shared.value.table()


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """(item_id, terms) of all items, in blocks of bounded size; rows of one item_id are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = []
            for _, words in words_of(batch.column("text")):
                raw = words.buffer.tobytes()
                spans = list(zip(words.begin.tolist(), words.size.tolist()))
                terms += [sorted({raw[a : a + n] for a, n in spans[i:j]}) for i, j in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "item_id long, terms array<binary>")
    one = rows.groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms")).orderBy("item_id")
    block, size = [], 0
    for row in one.toLocalIterator():
        terms = [bytes(term) for term in row["terms"]]
        if block and (len(block) == ITEMS or size + sum(map(len, terms)) > TERM_BYTES):
            yield block
            block, size = [], 0
        block.append((row["item_id"], terms))
        size += sum(map(len, terms))
    if block:
        yield block


def _counted(docs: DataFrame, words: Vocabulary) -> Vocabulary:
    """words with the documents that hold each term, those with any term at all, and all their terms."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, size = _table(shared), len(shared.value.terms)
        df = np.zeros(size + 2, np.int64)
        for batch in batches:
            lengths, term, _, _ = postings(batch.column("text"), table)
            df[:size] += np.bincount(term, minlength=size)
            df[size:] += [(lengths > 0).sum(), lengths.sum()]
        pa.default_memory_pool().release_unused()
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], ["term", "n"])

    made = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = np.zeros(len(words.terms) + 2, np.int64)
    for row in made.toLocalIterator():  # a row per term of the block
        df[row["term"]] = row["n"]
    words.df, words.n_docs, words.all_terms = df[:-2], int(df[-2]), int(df[-1])
    return words


def _searched(docs: DataFrame, ids: list[int | None], words: Vocabulary, k: int, slope: int, saturation: int) -> DataFrame:
    """(item_id, doc_id, score): the k best of each task for each item."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, own = _table(shared), shared.value
        w, best = weight(own.n_docs, own.df), [Best(k) for _ in own.items]
        for batch in batches:
            lengths, term, text, tf = postings(batch.column("text"), table)
            m = norm(lengths, own.n_docs, own.all_terms, slope)
            part = (SCALE * tf) // (UNIT * tf + saturation * m[text])
            first = np.searchsorted(term, np.arange(len(own.terms) + 1))
            most = np.zeros(len(own.terms), np.int64)
            np.maximum.at(most, term, part)
            doc = batch.column("doc_id")
            null, doc = doc.is_null().to_numpy(zero_copy_only=False), pc.fill_null(doc, 0).to_numpy()
            for item, top in zip(own.items, best):
                at, score = answer(item, w, part, most, first, text, batch.num_rows, top)
                if len(at):
                    top.add(score, doc[at], null[at])
        pa.default_memory_pool().release_unused()
        for number, top in enumerate(best):
            if len(top.score):
                yield pa.RecordBatch.from_arrays([pa.array([ids[number]] * len(top.score), pa.int64()), pa.array(top.doc, mask=top.null), pa.array(top.score)], ["item_id", "doc_id", "score"])

    return docs.mapInArrow(run, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 50, slope: int = 50, saturation: int = 20) -> DataFrame:
    """(item_id, rank from 1, doc_id, score): the k documents of highest score above zero for each item, equal scores by
    doc_id (null last).

    A term is a run of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. A score adds up, over an
    item's different terms, weight * (SCALE * tf div (UNIT * tf + saturation * m)), all whole numbers. Rows of one item_id
    are one item (null is one too); an item without terms has no row, nor has a document without any. Repeated documents
    are ranked each. Empty tables give an empty result. Items are answered in blocks of ITEMS, documents all at once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = []
    for block in _item_blocks(items):
        parts[-1:] = [written(part, "found") for part in parts[-1:]]  # one plan for each block
        words = _counted(rows, Vocabulary([terms for _, terms in block]))
        found = _searched(rows, [item for item, _ in block], words, k, slope, saturation).withColumn("_part", F.spark_partition_id() % MERGED)
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        some = found.withColumn("_n", F.row_number().over(Window.partitionBy("item_id", "_part").orderBy(*order))).where(F.col("_n") <= k)
        ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
        parts.append(ranked.select("item_id", "rank", "doc_id", "score"))
    none = rows.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, parts) if parts else none

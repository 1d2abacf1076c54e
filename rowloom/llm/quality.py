"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed where the text lies. The trees are fitted on a bounded sample of labelled rows (SAMPLE), whose
statistics alone come to the driver; they are flattened into arrays and walked by numpy, all rows of a batch at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.batches import sliced, texts

#: Labelled rows that the trees are fitted on at most: those with the smallest hashes of their doc_id.
SAMPLE = 20_000

_LONG_RUN = re.compile(rb"([^\s\w])\1\1")
_ENDS = frozenset(b".!?:;\"')")

#: Classes of bytes: upper and lower case letters, digits, blanks, sentence marks, other ASCII marks, beyond ASCII.
_CLASS = np.full(256, 6, np.int64)
_CLASS[:128] = 5
_CLASS[[*range(65, 91)]] = 0
_CLASS[[*range(97, 123)]] = 1
_CLASS[[*range(48, 58)]] = 2
_CLASS[[*range(9, 14), 32]] = 3
_CLASS[[ord(c) for c in ".,;:!?'\""]] = 4

FEATURES = [
    "log_bytes", "log_words", "upper", "lower", "digits", "blanks", "sentence_marks", "other_marks", "wide",
    "word_bytes", "distinct_words", "commonest_word", "mark_runs", "upper_words", "marked_words", "log_lines",
    "line_words", "distinct_lines", "ended_lines", "pipes", "short_words", "exclaims", "distinct_pairs",
]


def statistics(text: str) -> list[float]:
    """The FEATURES of a text; ratios of an empty one are zero."""
    raw = text.encode("utf-8", "surrogatepass")
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, w, k = max(len(raw), 1), max(len(words), 1), max(len(lines), 1)
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=7) / n
    lowered = raw.lower().split()
    distinct = set(lowered)
    counts: dict[bytes, int] = {}
    for word in lowered:
        counts[word] = counts.get(word, 0) + 1
    pairs = len(set(zip(lowered, lowered[1:])))
    return [
        np.log1p(len(raw)), np.log1p(len(words)), *kinds,
        (len(raw) - len(words)) / w, len(distinct) / w, max(counts.values(), default=0) / w,
        len(_LONG_RUN.findall(raw)) / w,
        sum(map(bytes.isupper, words)) / w,
        sum(not x[-1:].isalnum() and x[-1] < 128 for x in words) / w,
        np.log1p(len(lines)), w / k, len(set(lines)) / k, sum(x.rstrip()[-1] in _ENDS for x in lines) / k,
        raw.count(b"|") / w, sum(len(x) <= 3 for x in words) / w, raw.count(b"!") / w, pairs / w,
    ]


@dataclass
class Forest:
    """Trees of one depth as arrays: feature and cut of each inner node in breadth-first order, values of the leaves."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of x."""
        margin = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            margin += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, leaf_weight: float = 5.0, penalty: float = 1.0) -> Forest:
    """Gradient boosting of the logistic loss on histograms of binned columns. Without rows, or with one class only,
    the score is the smoothed share of label 1."""
    inner, share = 2**depth - 1, (y.sum() + 1) / (len(y) + 2)
    forest = Forest(float(np.log(share / (1 - share))), np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), depth)
    if len(np.unique(y)) < 2:
        return forest
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    codes = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T)], axis=1)
    n_features, margin = x.shape[1], np.full(len(y), forest.base)
    offsets = np.arange(n_features) * bins
    made = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = p - y, p * (1 - p)
        node, feature, cut = np.zeros(len(y), np.int64), np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            slots = ((node - first)[:, None] * (n_features * bins) + offsets + codes).ravel()
            shape = (width, n_features, bins)
            g = np.bincount(slots, np.repeat(gradient, n_features), width * n_features * bins).reshape(shape).cumsum(axis=2)
            h = np.bincount(slots, np.repeat(hessian, n_features), width * n_features * bins).reshape(shape).cumsum(axis=2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + penalty) + (g_all - g) ** 2 / (h_all - h + penalty) - g_all**2 / (h_all + penalty)
            gain[(h < leaf_weight * 0.1) | (h_all - h < leaf_weight * 0.1)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for i in range(width):
                f, b = divmod(int(best[i]), bins)
                if gain[i, f, b] > 1e-9 and b < len(cuts[f]):
                    feature[first + i], cut[first + i] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        g, h = (np.bincount(node - inner, v, inner + 1) for v in (gradient, hessian))
        leaf = -rate * g / (h + penalty)
        margin += leaf[node - inner]
        made.append((feature, cut, leaf))
    forest.feature, forest.cut, forest.leaf = (np.stack(part) for part in zip(*made))
    return forest


def held_out(doc_id):
    """Rows that are kept from fitting: crc32 of the id's decimal text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest:
    """Trees fitted on `sample` labelled rows at most. Labels of held-out rows and null labels are never read; of
    several labels of one doc_id each counts."""
    rows = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    rows = rows.select("doc_id", F.col("quality").cast("double").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)
    # the sample is bounded, so is what is broadcast
    chosen = docs.select("doc_id", "text").join(F.broadcast(rows.withColumnRenamed("doc_id", "_of")), F.col("doc_id") == F.col("_of"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            x = [statistics(text) for text in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    # a doc_id may stand in many rows: no more than the sample come to the driver, those with the smallest hashes of their numbers
    made = chosen.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "y").mapInArrow(run, "doc_id long, y double, x array<double>")
    found = made.orderBy(F.xxhash64("doc_id", "y", "x"), "doc_id", "y", "x").limit(sample).toArrow()
    x = np.array(found.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    y = found.column("y").to_numpy()
    order = np.lexsort((*x.T, y, found.column("doc_id").to_numpy()))
    return fit(x[order], (y[order] > 0.5).astype(float))


def scored(docs: DataFrame, forest: Forest, *columns: str) -> DataFrame:
    """The given columns of docs, then score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            x = np.array([statistics(text) for text in texts(batch.column(0))], float)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(forest.score(x))], [*batch.schema.names[1:], "score"])

    schema = docs.select(*columns).schema.add("score", "double")
    return docs.select(F.col("text").alias("_scored_text"), *columns).mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted.

    A null text is scored as an empty one; a null doc_id is not held out and has no label. Repeated rows stay repeated.
    Without usable labels every score is the prior 0.5. An empty table gives an empty result. No column but text
    goes into a score."""
    rows = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), train(docs, labels, sample), "doc_id")
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """docs without the rows that the classifier rejects, all columns kept."""
    names = docs.columns
    hidden = docs.toDF(*(f"c{i}" for i in range(len(names)))).withColumn("text", F.col(f"c{names.index('text')}"))
    rows = scored(hidden, train(docs, labels, sample), *hidden.columns[:-1]).where(F.col("score") >= threshold).drop("score")
    return rows.toDF(*names)

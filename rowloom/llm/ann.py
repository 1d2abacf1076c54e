"""Approximate nearest neighbours with learned partitions.

A bounded sample of the vectors gives a neighbour graph, which recursive spectral bisection cuts into parts of equal
size. A small classifier learns, for each sampled vector, how its neighbours spread over the parts. Every row is indexed
in its most probable part; a query is routed to its most probable parts, as many as it takes to gather the probability
that gave the wanted recall on sampled queries, and all rows of these parts are reranked by the exact inner product.

Parts are split into blocks of at most BLOCK rows and BLOCK_BYTES, so a part that holds many rows is many tasks, and each
task returns only the best of its block. A query's vector goes to each block of its parts once, in single precision where
the embeddings have that; blocks are as large as a worker's memory allows, so that these are few.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.batches import sliced
from rowloom.llm.tables import written

#: Vectors that the partition and the classifier are fitted on at most: those with the smallest hashes of their id.
SAMPLE = 8_192
#: Rows a part should hold, least and most parts, sampled vectors that a part needs, rows of a block at most.
PART_ROWS, LEAST_PARTS, MOST_PARTS, PART_SAMPLE, BLOCK = 4_096, 8, 256, 60, 65_536
#: Bytes of a block's vectors at most, products computed at once.
BLOCK_BYTES, CELLS = 32 << 20, 1 << 20
#: Share of a sampled query's neighbours that routing must reach there.
TARGET_RECALL = 0.96


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k vectors with the largest inner product with each, itself left out."""
    found = []
    for start in range(0, len(x), 256):
        near = x[start : start + 256] @ x.T
        near[np.arange(len(near)), np.arange(start, start + len(near))] = -np.inf
        found.append(np.argpartition(-near, k - 1, axis=1)[:, :k])
    return np.concatenate(found)


def balanced_parts(graph: np.ndarray, levels: int, seed: int = 7, steps: int = 40) -> np.ndarray:
    """2**levels parts of equal size, by halving along the second eigenvector of each part's subgraph."""
    n, k = graph.shape
    a, b = np.repeat(np.arange(n), k), graph.ravel()
    part, rng = np.zeros(n, np.int64), np.random.default_rng(seed)
    for _ in range(levels):
        inside = part[a] == part[b]
        s, t = np.concatenate([a[inside], b[inside]]), np.concatenate([b[inside], a[inside]])
        degree = np.bincount(s, minlength=n) + 1.0
        sizes = np.bincount(part, degree)
        v = rng.standard_normal(n)
        for _ in range(steps):
            v -= (np.bincount(part, degree * v) / sizes)[part]
            v = (np.bincount(s, v[t], n) + v) / degree * 0.5 + v * 0.5
            v /= (np.sqrt(np.bincount(part, v * v) / np.bincount(part)) + 1e-12)[part]
        order = np.lexsort((np.arange(n), v, part))
        rank = np.empty(n, np.int64)
        starts = np.cumsum(np.bincount(part)) - np.bincount(part)
        rank[order] = np.arange(n) - starts[part[order]]
        part = 2 * part + (rank >= np.bincount(part)[part] / 2)
    return part


@dataclass
class Router:
    """A classifier with one hidden layer: probabilities of the parts for each vector."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    mass: float = 1.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        hidden = np.maximum(x / np.where(norm > 0, norm, 1) @ self.w1 + self.b1, 0)
        z = hidden @ self.w2 + self.b2
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def routes(self, x: np.ndarray, rows: np.ndarray, least: int) -> list[np.ndarray]:
        """For each vector its most probable parts that together hold the mass and, of the index's rows by part, at
        least as many as asked for."""
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        gathered = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
        short = (gathered < self.mass) | (np.cumsum(rows[order], axis=1) < least)
        counts = np.minimum(short.sum(axis=1) + 1, p.shape[1])
        return [row[:n] for row, n in zip(order, counts)]


def fit_classifier(x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 30, rate: float = 3e-3, seed: int = 7) -> Router:
    """Cross-entropy against the spread of each vector's neighbours, by Adam."""
    rng, parts = np.random.default_rng(seed), target.shape[1]
    weights = [rng.standard_normal((x.shape[1], hidden)) * np.sqrt(2 / x.shape[1]), np.zeros(hidden),
               rng.standard_normal((hidden, parts)) * np.sqrt(1 / hidden), np.zeros(parts)]
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    x = x / np.where(norm > 0, norm, 1)
    first, second, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for start in range(0, len(x), 256):
            rows, t = order[start : start + 256], t + 1
            router = Router(*weights)
            hid = np.maximum(x[rows] @ weights[0] + weights[1], 0)
            error = (router.probabilities(x[rows]) - target[rows]) / len(rows)
            back = (error @ weights[2].T) * (hid > 0)
            for i, g in enumerate((x[rows].T @ back, back.sum(axis=0), hid.T @ error, error.sum(axis=0))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                step = rate * (1 - epoch / epochs)
                weights[i] = weights[i] - step * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
    return Router(*weights)


def levels_of(rows: int, sampled: int) -> int:
    """Halvings for an index of `rows` rows: parts of PART_ROWS, but no more than the sample can tell apart."""
    wanted = min(MOST_PARTS, max(LEAST_PARTS, rows // PART_ROWS))
    return max(0, int(np.floor(np.log2(max(1, min(wanted, sampled // PART_SAMPLE))))))


def fit(x: np.ndarray, rows: int, k: int, target_recall: float = TARGET_RECALL) -> Router:
    """The router for an index of `rows` rows, fitted on sampled vectors. A quarter of the sample is kept from the
    classifier's fit and settles how much probability a query must gather."""
    levels = levels_of(rows, len(x))
    if levels == 0:  # a handful of vectors: one part has them all
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    k = min(k, len(x) - 1)
    graph = neighbour_graph(x, k)
    part = balanced_parts(graph, levels)
    spread = np.zeros((len(x), 1 << levels))
    np.add.at(spread, (np.arange(len(x)), part), 1.0)
    np.add.at(spread, (np.repeat(np.arange(len(x)), k), part[graph.ravel()]), 1.0)
    spread /= spread.sum(axis=1, keepdims=True)
    test = np.arange(len(x)) % 4 == 3
    router = fit_classifier(x[~test], spread[~test])
    p = router.probabilities(x)
    home = p.argmax(axis=1)
    ahead = np.empty_like(p)  # the probability gathered before each part is looked at
    order = np.argsort(-p, axis=1, kind="stable")
    gathered = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
    np.put_along_axis(ahead, order, gathered - np.take_along_axis(p, order, axis=1), axis=1)
    needed = np.sort(np.take_along_axis(ahead[test], home[graph[test]], axis=1).ravel())
    router.mass = float(min(1.0, needed[min(len(needed) - 1, int(np.ceil(target_recall * len(needed))))] + 1e-9))
    return router


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (floats where the embeddings are, else doubles): rows that take part. Null ids, null, empty or zero vectors and those with null, NaN or
    infinite components do not."""
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("vector"))
    return rows.where(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda v: v != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(float)


def _index(rows: DataFrame, router: Router) -> DataFrame:
    """vec_id, vector, part: each row in its most probable part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 4096):
            part = router.probabilities(_matrix(batch.column("vector"))).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int32))], ["vec_id", "vector", "part"])

    return rows.mapInArrow(run, f"vec_id long, vector {_kind(rows)}, part int")


def _kind(rows: DataFrame) -> str:
    return rows.schema["vector"].dataType.simpleString()


def _routed(queries: DataFrame, router: Router, rows: np.ndarray, k: int) -> DataFrame:
    """vec_id, vector, part: each query in each part that it is routed to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1024):
            routes = router.routes(_matrix(batch.column("vector")), rows, k + 1)
            take = pa.array(np.repeat(np.arange(len(routes)), [len(r) for r in routes]))
            part = pa.array(np.concatenate(routes).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(take), batch.column("vector").take(take), part], ["vec_id", "vector", "part"])

    return queries.mapInArrow(run, f"vec_id long, vector {_kind(queries)}, part int")


def best_of_block(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query_id, vec_id, score) of each query's k best rows of a block, ties to smaller ids, the query's own left out."""
    found = []
    step = max(1, CELLS // len(x))
    for start in range(0, len(queries), step):
        near = queries[start : start + step] @ x.T
        for row, query_id, query in zip(near, query_ids[start : start + step], queries[start : start + step]):
            row[ids == query_id] = -np.inf
            bound = np.partition(row, len(row) - k)[len(row) - k] if k < len(row) else -np.inf
            chosen = np.flatnonzero((row >= bound - 1e-9 * (1 + abs(bound)) if np.isfinite(bound) else True) & (row > -np.inf))
            score = (x[chosen] * query).sum(axis=1)
            order = np.lexsort((ids[chosen], -score))[:k]
            found.append((np.full(len(order), query_id), ids[chosen][order], score[order]))
    return tuple(np.concatenate(part) for part in zip(*found))


def _reranked(rows: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score for the best rows of every block and each query that was routed to it.

    rows: part, block, is_query, vec_id, vector. A block's own rows come first and are held (BLOCK of them, about); the
    queries stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, x = None, [], []
        for batch in sliced(batches, 2048):
            part, block, is_query = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            bounds = np.flatnonzero((np.diff(part) != 0) | (np.diff(block) != 0) | (np.diff(is_query) != 0)) + 1
            for start, end in zip([0, *bounds], [*bounds, len(part)]):
                if at != (this := (part[start], block[start])):
                    at, ids, x = this, [], []
                vec_ids, vectors = batch.column(3).slice(start, end - start).to_numpy(), _matrix(batch.column(4).slice(start, end - start))
                if not is_query[start]:
                    ids.append(vec_ids)
                    x.append(vectors)
                elif ids:
                    ids, x = [np.concatenate(ids)], [np.concatenate(x)]
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in best_of_block(ids[0], x[0], vec_ids, vectors, k)], ["query_id", "vec_id", "score"])

    rows = rows.select("part", "block", "is_query", "vec_id", "vector").repartition("part", "block")
    return rows.sortWithinPartitions("part", "block", "is_query", "vec_id").mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query, k: int = 20, sample: int = SAMPLE, target_recall: float = TARGET_RECALL) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (inner product): for each query its k nearest rows found.

    vectors: vec_id, embedding. is_query: a condition on vec_id. Every usable row (see `usable`) is a candidate of every
    query but those of its own id; rows that repeat a vec_id are candidates each, and of such queries the smallest vector
    asks. Vectors of another length than most of the sample take no part. Of equal scores the smaller vec_id is nearer. An empty table gives an empty result; other
    columns are not looked at."""
    rows = usable(vectors)
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow().column("vector").combine_chunks()
    lengths = drawn.value_lengths().to_numpy(zero_copy_only=False)
    length = int(np.bincount(lengths).argmax()) if len(drawn) else 1
    rows = rows.where(F.size("vector") == length)
    x = _matrix(drawn.filter(pa.array(lengths == length))) if len(drawn) else np.zeros((0, length))
    router = fit(x, rows.count(), k, target_recall)
    index = written(_index(rows, router), "vector-index")
    by_part = {row["part"]: row["n"] for row in index.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = np.array([by_part.get(i, 0) for i in range(len(router.b2))])
    size = max(1, min(BLOCK, BLOCK_BYTES // (8 * length)))
    blocks = F.array(*[F.lit(max(1, -(-int(n) // size))) for n in parts])
    held = index.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.get(blocks, F.col("part")).cast("long")).cast("int"))
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))  # one query per id
    asked = _routed(asked, router, parts, k)
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.get(blocks, F.col("part")) - 1)))
    both = held.withColumn("is_query", F.lit(False)).unionByName(asked.withColumn("is_query", F.lit(True)))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return _reranked(both, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Mixture-controlled packing by deficit round-robin.

Each source is a queue of token ids. The queues are the leaves of a binary tree. Whatever number of tokens a node has
served so far, its left child has served its share of them, rounded; what rounding takes from a child is its deficit, and
the child gets it as soon as it comes to a whole token. So every window of `size` tokens holds the target proportions,
shares far below one token a window included, and what a queue has been served by any window has a closed form: a walk
from the root to its leaf. Any task can tell, for any window, which tokens of which queue it holds; deficits carry over
from window to window and from one partition to the next without a pass over the windows.

With a mixture, one set of weights holds until a queue runs out (a phase). The window in which that happens is filled
from what the others have, and the next phase shares out the mixture among those left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.batches import sliced, texts
from rowloom.llm.tables import written
from rowloom.llm.wordbpe import CACHED, encoder

#: Sources with a queue of their own, those with most tokens; all others share the last queue, in the order of their
#: documents' hashes. Sources that a mixture names always have their own.
QUEUES = 256
#: A mixture's weights become whole numbers that add up to about this.
SCALE = 1 << 40
#: A queue is cut into buckets of about this many rows of all, at most MOST_BUCKETS; each is ordered by itself.
BUCKET_ROWS, MOST_BUCKETS = 256, 65_536
#: Candidates for a piece looked at in one go.
CANDIDATES = 1 << 16


def part(served: np.ndarray, share: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """served * share / whole, rounded to the nearest whole number (halves up), exactly; zero where whole is.

    The product is taken modulo 2**64: its difference from the estimate's is small, so it is the true one."""
    near = np.floor(served * (share / np.maximum(whole, 1)) + 0.5).astype(np.int64)
    rest = served * share + whole // 2 - near * whole
    return np.where(whole > 0, near + (rest >= whole) - (rest < 0), 0)


@dataclass
class Phase:
    """Windows with one set of weights. weights: of all nodes, each row of the tree after the one above it."""

    first: int  # number of its first window
    windows: int
    begins: np.ndarray  # tokens of each queue that earlier phases have served
    weights: np.ndarray
    tokens: int  # that it serves in all

    @property
    def depth(self) -> int:
        return len(self.weights).bit_length() - 1

    def at(self, queue: np.ndarray, windows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens served before each of the windows: of the queue, and of all queues that come before it."""
        served = np.minimum(windows * size, self.tokens)
        node, ahead = np.zeros(len(served), np.int64), np.zeros(len(served), np.int64)
        for level in range(self.depth - 1, -1, -1):
            left = 2 * node + 1
            given = part(served, self.weights[left], self.weights[node])
            right = (queue >> level) & 1
            ahead += right * given
            served = np.where(right, served - given, given)
            node = left + right
        return served, ahead

    def before(self, windows: np.ndarray, size: int) -> np.ndarray:
        """Tokens served to each queue (columns) before each of the windows (rows)."""
        n = len(self.begins)
        served, _ = self.at(np.tile(np.arange(n), len(windows)), np.repeat(windows, n), size)
        return served.reshape(-1, n)

    def window_of(self, queue: np.ndarray, token: np.ndarray, size: int) -> np.ndarray:
        """The window of each token, counted from the phase's first one of its queue."""
        share = self.weights[(1 << self.depth) - 1 + queue] / self.weights[0] * size
        low = np.clip((token - self.depth) / share - 2, 0, self.windows - 1).astype(np.int64)
        high = np.clip((token + self.depth) / share + 2, 0, self.windows - 1).astype(np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            reached = self.at(queue, middle + 1, size)[0] > token
            low, high = np.where(open_ & ~reached, middle + 1, low), np.where(open_ & reached, middle, high)
        return low


def _tree(weights: np.ndarray) -> np.ndarray:
    """The weights of all nodes above the given leaves."""
    rows = [np.pad(weights, (0, (1 << (len(weights) - 1).bit_length()) - len(weights)))]
    while len(rows[0]) > 1:
        rows.insert(0, rows[0].reshape(-1, 2).sum(axis=1))
    return np.concatenate(rows)


def _weights(mixture: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Whole weights of the queues that have tokens left; those of the tokens themselves where the mixture has none."""
    held = np.where(left > 0, np.maximum(mixture, 0.0), 0.0)
    if held.sum() <= 0:
        return left
    return np.where(held > 0, np.maximum(1, np.round(held / held.sum() * SCALE)), 0).astype(np.int64)


def _last_window(mixture: np.ndarray, left: np.ndarray, size: int) -> np.ndarray:
    """What each queue gives to a window in which some run out."""
    counts = np.zeros_like(left)
    while (room := min(size, int(left.sum())) - int(counts.sum())) > 0:
        phase = Phase(0, 1, counts, _tree(_weights(mixture, left - counts)), room)
        counts = counts + np.minimum(phase.before(np.array([1]), room)[0], left - counts)
    return counts


def plan(totals: list[int], size: int, mixture: list[float] | None = None) -> list[Phase]:
    """Phases that serve all tokens of all queues. mixture: target weights; without it, each queue's share of all
    tokens, so that all queues last to the end. Queues of weight zero come when all others have run out."""
    left, done, first, phases = np.array(totals, np.int64), np.zeros(len(totals), np.int64), 0, []
    wanted = np.array(mixture, float) if mixture else np.zeros(len(totals))
    while left.sum() > 0:
        weights = _weights(wanted, left)
        n, over = 0, int(left.sum()) // size + 1
        phase = Phase(first, over, done, _tree(weights), over * size)
        if weights is left:  # shares of what is left never exceed it
            n = over - 1
        while over - n > 1:  # the last number of windows for which all have tokens enough
            middle = (n + over) // 2
            n, over = (middle, over) if (phase.before(np.array([middle]), size)[0] <= left).all() else (n, middle)
        if n:
            phase.windows, phase.tokens = n, n * size
            served = phase.before(np.array([n]), size)[0]
        else:
            served = _last_window(wanted, left, size)
            phase = Phase(first, 1, done, _tree(served), int(served.sum()))
        phases.append(phase)
        first, done, left = first + phase.windows, done + served, left - served
    return phases


def pieces(phases: list[Phase], queue: np.ndarray, start: np.ndarray, length: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Cut token runs of queues at window bounds: (run, first token within the run, tokens, window, offset there)."""
    found = [tuple(np.zeros(0, np.int64) for _ in range(5))]
    for phase in phases:
        whole = phase.at(queue, np.full(len(queue), phase.windows), size)[0]
        low, high = np.maximum(start, phase.begins[queue]), np.minimum(start + length, phase.begins[queue] + whole)
        runs = np.flatnonzero(high > low)
        if not len(runs):
            continue
        q, skipped = queue[runs], phase.begins[queue[runs]]
        low, high = low[runs] - skipped, high[runs] - skipped
        w_low, w_high = phase.window_of(q, low, size), phase.window_of(q, high - 1, size)
        # candidates are the windows from the first to the last one; or the tokens, where these are fewer
        by_token = high - low < w_high - w_low + 1
        counts = np.where(by_token, high - low, w_high - w_low + 1)
        ends = np.cumsum(counts)
        for begin in range(0, int(ends[-1]), CANDIDATES):
            number = np.arange(begin, min(begin + CANDIDATES, int(ends[-1])))
            each = np.searchsorted(ends, number, side="right")
            step = number - (ends - counts)[each]
            window = w_low[each] + step
            single = np.flatnonzero(by_token[each])
            token = low[each[single]] + step[single]
            window[single] = phase.window_of(q[each[single]], token, size)
            here, ahead = phase.at(q[each], window, size)
            there, ahead_there = phase.at(q[each], window + 1, size)
            a, b = np.maximum(low[each], here), np.minimum(high[each], there)
            a[single], b[single] = token, token + 1
            offset = ahead_there - ahead + a - here
            real = b > a
            found.append((runs[each][real], (a + skipped[each] - start[runs[each]])[real], (b - a)[real], window[real] + phase.first, offset[real]))
    return tuple(np.concatenate(column) for column in zip(*found))


def token_table(docs: DataFrame, tokenizer: str, end_id: int, cached: int = CACHED) -> DataFrame:
    """source, doc_id, n, ids: the ids of each text and end_id, little-endian in two bytes where they fit, else four."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, cached)
        kind = "<u2" if max(own.size, end_id + 1) <= 1 << 16 else "<u4"
        last = np.array([end_id], kind).tobytes()
        for batch in sliced(batches):
            ids = [x.astype(kind).tobytes() + last for x in own.ids(texts(batch.column("text")))]
            n = pa.array([len(x) // int(kind[-1]) for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("source"), batch.column("doc_id"), n, pa.array(ids, pa.binary())], ["source", "doc_id", "n", "ids"])

    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "source string, doc_id long, n long, ids binary")


def _queue_of(names: list[str | None]) -> Column:
    """The number of a source's queue; the last queue is that of all sources not named."""
    key = lambda name: "n" if name is None else "s" + name
    last = F.lit(len(names))
    if not names:
        return last
    numbers = F.create_map(*[F.lit(x) for number, name in enumerate(names) for x in (key(name), number)])
    return F.coalesce(F.try_element_at(numbers, F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))), last)


def _names(like: DataFrame, names: list[str]) -> DataFrame:
    return like.sparkSession.createDataFrame([(name,) for name in names], "source string")


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, mixture: dict[str, float] | None = None, queues: int = QUEUES, cached: int = CACHED) -> DataFrame:
    """One row per piece: source, doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned
    32-bit). Every id of every row lies in one piece; all sequences but the last are full.

    mixture: target weight of each source; those that it does not name come last. Without it, sources keep their share of
    all tokens. Sources that the mixture does not name and that are not among the `queues` largest share one queue; null
    is a source like any other. A null text is an empty one, of end_id alone.
    cached: pre-tokens that a worker keeps in each generation; it changes time and memory, no result.
    Rows with a null doc_id and repeated rows are packed like others. An empty table gives an empty result. Columns
    other than doc_id, text and source are not looked at.
    """
    tokens = written(token_table(docs, tokenizer, end_id, cached).withColumn("row_key", F.monotonically_increasing_id()), "tokens")
    by_source = tokens.groupBy("source").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs"))
    everything = by_source.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("docs"), F.lit(0)).alias("docs")).first()
    named = by_source.where(F.col("source").isin(*mixture)).collect() if mixture else []  # no more than the mixture has
    others = by_source.join(F.broadcast(_names(tokens, [r["source"] for r in named])), "source", "left_anti") if named else by_source
    own = [*named, *others.orderBy(F.desc("n"), "source").limit(max(0, queues - 1)).collect()]
    names, totals = [row["source"] for row in own], [row["n"] for row in own]
    totals.append(everything["n"] - sum(totals))
    phases = plan(totals, size, [*(mixture.get(name, 0.0) for name in names), 0.0] if mixture else None)
    buckets = min(max(1, -(-everything["docs"] // BUCKET_ROWS)), MOST_BUCKETS)
    dealt = tokens.withColumns({"queue": _queue_of(names), "bucket": F.pmod(F.xxhash64("doc_id", "row_key"), F.lit(buckets)).cast("int")})
    # where each bucket begins in its queue: a short table, added as a row ahead of the bucket's own rows
    sums = dealt.groupBy("queue", "bucket").agg(F.sum("n").alias("n"))
    begins = F.sum("n").over(Window.partitionBy("queue").orderBy("bucket")) - F.col("n")
    heads = sums.select("queue", "bucket", F.lit(0).alias("kind"), begins.alias("n"))
    rows = dealt.withColumn("kind", F.lit(1)).unionByName(heads, allowMissingColumns=True)
    rows = rows.select("queue", "bucket", "kind", "doc_id", "row_key", "n", "source", "ids").repartition("queue", "bucket")
    rows = rows.sortWithinPartitions("queue", "bucket", "kind", "doc_id", "row_key")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder.cache_clear()  # what this worker has kept for the texts is of no use here
        at = 0
        for batch in sliced(batches, 256):
            kind, n = batch.column("kind").to_numpy(), batch.column("n").to_numpy()
            queue, head = batch.column("queue").to_numpy().astype(np.int64), kind == 0
            # running position: a head row sets it, each other row moves it on
            moved = np.where(head, 0, n)
            base = np.where(head, n - (np.cumsum(moved) - moved), 0)
            group = np.maximum.accumulate(np.where(head, np.arange(len(n)), -1))
            start = np.cumsum(moved) - moved + np.where(group >= 0, base[np.maximum(group, 0)], at)
            at = int(start[-1] + moved[-1]) if not head[-1] else int(n[-1])
            start = np.where(head, 0, start)
            run, first, count, window, offset = pieces(phases, queue, start, moved, size)
            ids = batch.column("ids").to_pylist()
            wide = {i: np.frombuffer(ids[i], f"<u{len(ids[i]) // n[i]}").astype("<u4") for i in np.unique(run).tolist()}
            cuts = [wide[i][a : a + c].tobytes() for i, a, c in zip(run.tolist(), first.tolist(), count.tolist())]
            take = pa.array(run)
            yield pa.RecordBatch.from_arrays(
                [batch.column("source").take(take), batch.column("doc_id").take(take), pa.array(first), pa.array(count), batch.column("n").take(take),
                 pa.array(window), pa.array(offset), pa.array(cuts, pa.binary())],
                ["source", "doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    schema = "source string, doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return rows.mapInArrow(cut, schema)

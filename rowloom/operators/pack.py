"""Parts, merges and script rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.operators.index import dense_index
from rowloom.sources.shared import reused

#: Texts of a key that are packed in one task; keys of more are packed in chunks.
LONG = 10_000
#: Positions of a script that are looked at in one task.
CHUNK = 4_096
#: Rows of a table that may be broadcast.
BROADCAST_ROWS = 100_000


def greedy_parts(df: DataFrame, key: str, pos: str, text: str, most: int = 100_000, overhead: int = 2) -> DataFrame:
    """(key, part_no from 1, n_items, part): consecutive texts of a key packed into parts of at most `most` characters,
    each text costing its length and `overhead`; one that is too long stands alone. Joined by a blank line. A null text
    is skipped. A fold over a key's array, within Catalyst; packed_parts takes keys of very many texts too."""
    start = F.struct(F.array().cast("array<array<string>>").alias("done"), F.array().cast("array<string>").alias("cur"), F.lit(0).cast("long").alias("len"))

    def step(acc: Column, item: Column) -> Column:
        cost = F.length(item["t"]).cast("long") + overhead
        full = (F.size(acc["cur"]) > 0) & (acc["len"] + cost > most)
        done = F.when(full, F.concat(acc["done"], F.array(acc["cur"]))).otherwise(acc["done"])
        cur = F.when(full, F.array(item["t"])).otherwise(F.concat(acc["cur"], F.array(item["t"])))
        return F.struct(done.alias("done"), cur.alias("cur"), F.when(full, cost).otherwise(acc["len"] + cost).alias("len"))

    def finish(acc: Column) -> Column:
        return F.when(F.size(acc["cur"]) > 0, F.concat(acc["done"], F.array(acc["cur"]))).otherwise(acc["done"])

    items = df.where(F.col(text).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(text).alias("t")))).alias("items"))
    parts = items.select(key, F.posexplode(F.aggregate("items", start, step, finish)).alias("n", "texts"))
    return parts.select(key, (F.col("n") + 1).alias("part_no"), F.size("texts").alias("n_items"), F.array_join("texts", "\n\n").alias("part"))


class _Cuts:
    """Greedy parts of consecutive costs, for every row that a part may begin with."""

    def __init__(self, costs: np.ndarray, most: int):
        self.most, self.ends = most, np.concatenate([[0], np.cumsum(costs)])
        n = len(costs)
        after = np.maximum(np.searchsorted(self.ends, self.ends[:-1] + most, side="right") - 1, np.arange(n) + 1)
        # pointer doubling: the last part reached from each row, and how many parts that makes
        self.last, self.parts = np.where(after < n, after, np.arange(n)), 1 + (after < n)
        while (further := self.last[self.last] != self.last).any():
            self.parts = np.where(further, self.parts + self.parts[self.last] - 1, self.parts)
            self.last = self.last[self.last]

    def left(self) -> np.ndarray:
        """What the open part holds after the last row, for each row that a part may begin with."""
        return self.ends[-1] - self.ends[self.last]

    def steps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(until, left, parts): a part that comes in with room for less than until[0] ends such that left[0] is open at
        the end and parts[0] have been begun; with less than until[1] ..."""
        rows = max(1, int(np.searchsorted(self.ends[:-1], self.most, side="right")))
        left, parts = self.left()[:rows], self.parts[:rows]
        kept = np.append((left[1:] != left[:-1]) | (parts[1:] != parts[:-1]), True)  # the last of equal ones
        return self.ends[1 : rows + 1][kept], left[kept], parts[kept]


def _segments(names: pa.Array) -> np.ndarray:
    """Where another key begins."""
    return np.flatnonzero(np.concatenate([[True], pc.not_equal(names[1:], names[:-1]).to_numpy(zero_copy_only=False)]))


_SUMMARY = "bucket int, place int, key string, total long, left long, parts long, until array<long>, step_left array<long>, step_parts array<long>"


def _summaries(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each range chunk the first key's rows and the last one's, as those alone may go on in other chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, name, costs, place, out = None, None, [], 0, []

        def close(last: bool):
            if name is None or (place and not last):
                return
            cuts = _Cuts(np.concatenate(costs), most)
            # only a chunk of one key can be entered and left by the same part
            until, left, parts = cuts.steps() if last and not place else ([], [], [])
            out.append((bucket, place, name, int(cuts.ends[-1]), int(cuts.left()[0]), int(cuts.parts[0]), list(until), list(left), list(parts)))

        for batch in batches:
            if not batch.num_rows:
                continue
            names, cost = batch.column("_key"), batch.column("_cost").to_numpy()
            bucket = batch.column("_bucket")[0].as_py()
            starts = _segments(names)
            for a, b in zip(starts, [*starts[1:], batch.num_rows]):
                if (own := names[int(a)].as_py()) != name:
                    close(False)
                    place += name is not None
                    name, costs = own, []
                costs.append(cost[a:b])
        close(True)
        columns = zip(*out) if out else [()] * 9
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds)], ["bucket", "place", "key", "total", "left", "parts", "until", "step_left", "step_parts"])

    return run


def _entries(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What the part open before each chunk holds (-1: none goes on) and its number, from the chunks' summaries in order:
    two short rows a chunk, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, number = None, -1, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                goes_on = row["place"] == 0 and row["key"] == key
                if row["place"] == 0:
                    out.append((row["bucket"], held if goes_on else -1, number if goes_on else 0))
                if not goes_on:
                    held, number = row["left"], row["parts"]
                elif held + row["total"] <= most:
                    held += row["total"]
                elif row["until"]:
                    i = int(np.searchsorted(row["until"], most - held, side="right"))
                    held, number = row["step_left"][i], number + row["step_parts"][i]
                key = row["key"]
            columns = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, (pa.int32(), pa.int64(), pa.int64()))], ["_of", "_held", "_number"])

    return run


def _numbered(most: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The part number of every row of a chunk, from what its first part holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, number = None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, cost, part = batch.column("_key"), batch.column("_cost").to_numpy(), np.empty(batch.num_rows, np.int64)
            starts = _segments(keys)
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
                own = keys[a].as_py()
                if name is None:  # the chunk's first row
                    held, number = batch.column("_held")[a].as_py(), batch.column("_number")[a].as_py()
                elif own != name:
                    held, number = -1, 0
                name, ends, at = own, np.cumsum(cost[a:b]), 0
                while at < b - a:
                    done = int(ends[at - 1]) if at else 0
                    room = most - max(held, 0)
                    fits = int(np.searchsorted(ends, done + room, side="right"))
                    if held < 0 or fits <= at:  # a new part, which takes its first row whatever that costs
                        number, held = number + 1, 0
                        fits = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
                    part[a + at : a + fits] = number
                    held += int(ends[fits - 1]) - done
                    at = fits
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(part, pa.int32())], [*names, "part_no"])

    return run


def greedy_parts_long(df: DataFrame, key: str, pos: str, text: str, most: int = 100_000, overhead: int = 2, chunks: int | None = None) -> DataFrame:
    """greedy_parts for keys of any size, a key that most rows have included.

    Rows are ranged by key and pos over `chunks` (by default the session's number of shuffle partitions, 64 at least). A
    chunk of one key tells, for whatever the part open before it holds, what is open after it and how many parts begin:
    a step function, from prefix sums of the costs and next-cut pointers that are doubled. Going through these, a row or
    two a chunk, settles what each chunk begins with; then all chunks number their parts at once, and parts are put
    together by key and number. Null is a key. Rows of one key and pos are in the order of their texts."""
    chunks = chunks or max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = df.where(F.col(text).isNotNull()).select(
        F.to_json(F.struct(F.col(key).alias("k"))).alias("_key"), F.col(key).alias("_own"), F.col(pos).alias("_pos"), F.col(text).alias("_text"), (F.length(text).cast("long") + overhead).alias("_cost"))
    ranged = rows.repartitionByRange(chunks, "_key", "_pos").sortWithinPartitions("_key", "_pos", "_text").withColumn("_bucket", F.spark_partition_id())
    ranged = reused(ranged)
    summaries = ranged.select("_bucket", "_key", "_cost").mapInArrow(_summaries(most), _SUMMARY)
    entries = summaries.coalesce(1).sortWithinPartitions("bucket", "place").mapInArrow(_entries(most), "_of int, _held long, _number long")
    # a row a chunk is broadcast
    known = ranged.join(F.broadcast(entries), F.col("_bucket") == F.col("_of"))
    kept = known.select("_own", "_pos", "_text")
    numbered = known.select("_key", "_cost", "_held", "_number", "_own", "_pos", "_text").mapInArrow(_numbered(most, kept.columns), kept.schema.add("part_no", "integer"))
    parts = numbered.groupBy("_own", "part_no").agg(F.sort_array(F.collect_list(F.struct("_pos", "_text"))).alias("t"))
    return parts.select(F.col("_own").alias(key), "part_no", F.size("t").alias("n_items"), F.array_join(F.transform("t", lambda x: x["_text"]), "\n\n").alias("part"))


def packed_parts(df: DataFrame, key: str, pos: str, text: str, most: int = 100_000, overhead: int = 2, long: int = LONG) -> DataFrame:
    """greedy_parts, with keys of more than `long` texts packed by greedy_parts_long: the same parts at any size."""
    rows = df.where(F.col(text).isNotNull()).select(key, pos, text)
    hot = reused(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > long).select(F.col(key).alias("_hot")))
    if hot.isEmpty():
        return greedy_parts(rows, key, pos, text, most, overhead)
    same = F.col(key).eqNullSafe(F.col("_hot"))
    return greedy_parts(rows.join(hot, same, "left_anti"), key, pos, text, most, overhead).unionByName(greedy_parts_long(rows.join(hot, same, "left_semi"), key, pos, text, most, overhead))


def part_columns(parts: DataFrame, key: str, most: int, name: str = "comments") -> DataFrame:
    """Parts as columns name_1 .. name_most, and how many parts there are (parts beyond `most` are counted only)."""
    made = [F.max(F.when(F.col("part_no") == i, F.col("part"))).alias(f"{name}_{i}") for i in range(1, most + 1)]
    return parts.groupBy(key).agg(F.count(F.lit(1)).alias("n_parts"), *made)


def permuted(i: Column, n: int, *key: Column) -> Column:
    """Where a keyed permutation of 0 .. n-1 puts i. Each round pairs numbers that add up to the round's own number (mod
    n) and swaps the pair or not, by a bit of the md5 of key, round and the greater of the two; so every round maps 0 ..
    n-1 onto itself, whatever n is."""
    number = lambda *of: F.conv(F.substring(F.md5(F.concat_ws("|", *key, *(x.cast("string") for x in of))), 1, 13), 16, 10).cast("long")

    def swapped(x: Column, r: Column) -> Column:
        other = F.pmod(number(r) - x, F.lit(n))
        return F.when(number(r, F.greatest(x, other)) % 2 == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(4 * max(4, n.bit_length()))), i.cast("long"), swapped)


def chunk_merges(df: DataFrame, id_column: str, text: str, k: int, times: int, seed: str = "merge") -> DataFrame:
    """(merge_no, ids, text): `times` draws of k distinct rows, their ids and texts joined in order of id.

    A draw's rows are the first k of a permutation keyed by seed and merge, so k of them are made for any k, without
    repeats. They are joined to row numbers, so no draw looks at more than its own rows. More than there are rows is an
    error."""
    numbered = dense_index(df.select(F.col(id_column).alias("_id")), "_id")
    n = numbered.count()
    if k > n:
        raise ValueError(f"{k} rows wanted of {n}")
    draws = df.sparkSession.range(1, times + 1).withColumnRenamed("id", "merge_no").select(
        "merge_no", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("slot"))
    picked = draws.select("merge_no", (permuted(F.col("slot"), n, F.lit(seed), F.col("merge_no").cast("string")) + 1).alias("rn"))
    wanted = picked.join(numbered, "rn").select("merge_no", "_id")
    if times * k <= BROADCAST_ROWS:  # then the texts of all other rows stay where they are
        wanted = F.broadcast(wanted)
    joined = df.select(F.col(id_column).alias("_id"), F.col(text).alias("_text")).join(wanted, "_id")
    rows = joined.groupBy("merge_no").agg(F.sort_array(F.collect_list(F.struct("_id", "_text"))).alias("r"))
    return rows.select(
        "merge_no",
        F.array_join(F.transform("r", lambda r: r["_id"].cast("string")), ", ").alias("ids"),
        F.array_join(F.transform("r", lambda r: r["_text"]), "\n-----------\n").alias("text"),
    )


def until_blanks(df: DataFrame, script: str, pos: str, blank: Column, run: int = 3, chunk: int = CHUNK) -> DataFrame:
    """The rows of each script that are not blank, up to its first `run` blank rows on end. pos counts a script's rows
    without gaps.

    Rows are dealt by script and chunk of `chunk` positions. A chunk tells how many rows it has, how many blank ones it
    begins and ends with, and where it has the first run within; from these rows, one a chunk, follows how many blank ones
    go before each chunk, so where the first run ends that crosses a border. A null script is one too."""
    rows = df.withColumns({"_blank": F.coalesce(blank, F.lit(True)), "_chunk": F.floor(F.col(pos) / chunk).cast("long"), "_script": F.to_json(F.struct(F.col(script).alias("s")))})
    inside = Window.partitionBy("_script", "_chunk").orderBy(pos)
    ended = F.col("_blank")
    for back in range(1, run):
        ended = ended & F.coalesce(F.lag("_blank", back).over(inside), F.lit(False))
    rows = rows.withColumns({"_at": F.row_number().over(inside), "_ended": ended})
    said = ~F.col("_blank")
    chunks = rows.groupBy("_script", "_chunk").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.when(said, F.col("_at"))).alias("_first"), F.max(F.when(said, F.col("_at"))).alias("_last"), F.min(F.when(F.col("_ended"), F.col("_at"))).alias("_run"))
    before = Window.partitionBy("_script").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row a chunk
    chunks = chunks.withColumn("_done", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    chunks = chunks.withColumn("_blanks", F.col("_done") - F.coalesce(F.max(F.col("_done") + F.col("_last")).over(before), F.lit(0)))
    needed = F.greatest(run - F.col("_blanks"), F.lit(0))
    crossing = F.when((F.col("_blanks") > 0) & (F.coalesce(F.col("_first") - 1, F.col("_n")) >= needed), needed)
    chunks = chunks.withColumn("_stop", F.least("_run", crossing))
    chunks = chunks.withColumn("_over", F.max(F.col("_stop").isNotNull()).over(before))
    cuts = chunks.select(F.col("_script").alias("_of"), F.col("_chunk").alias("_of_chunk"), F.when(F.coalesce("_over", F.lit(False)), F.lit(0)).otherwise(F.col("_stop")).alias("_cut"))
    joined = rows.join(cuts, (F.col("_script") == F.col("_of")) & (F.col("_chunk") == F.col("_of_chunk")))
    kept = joined.where(~F.col("_blank") & (F.col("_cut").isNull() | (F.col("_at") < F.col("_cut"))))
    return kept.select(*(rows[c] for c in df.columns))

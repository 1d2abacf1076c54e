"""Packing, blank runs and draws where one key has most of the rows, against plain Python."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.operators import pack


def greedy(texts, most, overhead):
    parts, held, size = [], [], 0
    for text in texts:
        cost = len(text) + overhead
        if held and size + cost > most:
            parts.append(held)
            held, size = [], 0
        held.append(text)
        size += cost
    return parts + [held] if held else parts


def packed_by_hand(rows, most, overhead):
    wanted = []
    for key in {k for k, _, _ in rows}:
        texts = [t for _, t in sorted((p, t) for k, p, t in rows if k == key and t is not None)]
        wanted += [(key, n, len(part), "\n\n".join(part)) for n, part in enumerate(greedy(texts, most, overhead), 1)]
    return sorted(wanted, key=str)


BIG = 9_007_199_254_740_992


@pytest.mark.parametrize("chunks", [1, 7])
@pytest.mark.parametrize("most, overhead", [(20, 2), (40, 0), (7, 1)])
def test_parts_of_hot_keys(spark, chunks, most, overhead):
    rng = random.Random(most + chunks)
    rows = [(None, i, "n" * rng.randrange(9)) for i in range(60)]
    rows += [(BIG + k, i, f"{k}" * rng.choice([0, 1, 3, 30])) for k in (0, 1, 2) for i in range(25)]
    rows += [(7, i, "x" * rng.randrange(12)) for i in range(400)] + [(8, i, "four") for i in range(200)] + [(9, 0, None), (10, 0, "y" * 99), (10, 1, ""), (10, 1, "")]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "k long, pos int, t string").repartition(5)
    got = pack.greedy_parts_long(df, "k", "pos", "t", most, overhead, chunks)
    assert got.columns == ["k", "part_no", "n_items", "part"]
    assert sorted(map(tuple, got.collect()), key=str) == packed_by_hand(rows, most, overhead)
    if chunks == 7 and most == 20:
        for long in (0, 100):
            assert sorted(map(tuple, pack.packed_parts(df, "k", "pos", "t", most, overhead, long).collect()), key=str) == packed_by_hand(rows, most, overhead)


def test_parts_of_text_keys(spark):
    rows = [(k, i, "ab" * (i % 5)) for k in ("a", "A", 'q"', "", None, "é") for i in range(30)]
    df = spark.createDataFrame(rows, "key string, part int, text string")
    assert sorted(map(tuple, pack.greedy_parts_long(df, "key", "part", "text", 25, 2, 8).collect()), key=str) == packed_by_hand(rows, 25, 2)
    assert pack.greedy_parts_long(df.limit(0), "key", "part", "text").count() == pack.packed_parts(df.limit(0), "key", "part", "text").count() == 0


def test_a_hot_key_is_spread(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"), "id", F.lit("some text").alias("t"))
    parts = pack.greedy_parts_long(df, "k", "id", "t", 110, 2, 16)
    text = parts._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_own" in text and "_key#" in text and parts.count() == 2_000
    shares = [r.n for r in df.repartitionByRange(16, "k", "id").groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(shares) == 16 and max(shares) < 4 * min(shares)


def test_cuts_against_a_walk():
    rng = np.random.default_rng(3)
    for costs in (rng.integers(0, 9, 200), np.full(50, 3), rng.integers(0, 60, 80), np.zeros(5, int), np.array([99])):
        cuts = pack._Cuts(costs, 20)
        until, left, parts = cuts.steps()
        for held in range(45):
            size, number = held, 0
            for cost in costs:
                if size + cost > 20:
                    size, number = 0, number + 1
                size += cost
            if held + costs.sum() <= 20:
                assert (size, number) == (held + costs.sum(), 0)
                continue
            i = np.searchsorted(until, 20 - held, side="right")
            assert (left[i], parts[i]) == (size, number)


def blanks_by_hand(rows, run):
    kept = []
    for script in {s for s, _, _ in rows}:
        blank = 0
        for _, pos, said in sorted((r for r in rows if r[0] == script), key=lambda r: r[1]):
            blank = 0 if said else blank + 1
            if blank == run:
                break
            if said:
                kept.append((script, pos, said))
    return sorted(kept, key=str)


@pytest.mark.parametrize("chunk", [1, 3, 4_096])
def test_blank_runs_across_chunks(spark, chunk):
    rng = random.Random(chunk)
    rows = [(s, i, rng.choice([None, None, "a", "b"]) if s % 2 else rng.choice([None, "a", "b", "c"])) for s in range(40) for i in range(rng.randrange(1, 30))]
    rows += [(None, i, "x" if i % 3 else None) for i in range(50)] + [(90, i, None) for i in range(9)] + [(91, i, "full") for i in range(9)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "script long, pos long, said string").withColumn("extra", F.lit(1))
    for run in (1, 3):
        got = pack.until_blanks(df, "script", "pos", F.col("said").isNull(), run, chunk)
        assert got.columns == df.columns
        assert sorted(((r.script, r.pos, r.said) for r in got.collect()), key=str) == blanks_by_hand(rows, run)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "_chunk" in text and pack.until_blanks(df.limit(0), "script", "pos", F.col("said").isNull()).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 10, 64, 1_001])
def test_permutation(spark, n):
    df = spark.range(n).crossJoin(spark.range(3).withColumnRenamed("id", "m")).select("m", "id", pack.permuted(F.col("id"), n, F.lit("s"), F.col("m").cast("string")).alias("to"))
    orders = {}
    for r in sorted(df.collect()):
        orders.setdefault(r.m, []).append(r.to)
    assert all(sorted(order) == list(range(n)) for order in orders.values())
    assert n < 10 or len(set(map(tuple, orders.values()))) == 3


def test_merges_of_nearly_all_rows(spark):
    df = spark.range(1, 51).select("id", F.concat(F.lit("t"), F.col("id").cast("string")).alias("t"))
    got = pack.chunk_merges(df, "id", "t", 49, 30).collect()
    missing = [set(range(1, 51)) - {int(i) for i in r.ids.split(", ")} for r in got]
    assert len(got) == 30 and all(len(m) == 1 for m in missing) and len(set.union(*missing)) > 10
    assert all(len(r.text.split("\n-----------\n")) == 49 for r in got)
    few = pack.chunk_merges(df, "id", "t", 2, 2_000).collect()
    assert len(few) == 2_000 and len({tuple(itertools.chain(r.ids.split(", "))) for r in few}) > 900

"""Tables of runs: what is written grows with what is added."""

import os
import random

import pytest
from pyspark.sql import functions as F

from rowloom.sources import runs
from rowloom.streaming.feed import feed_log, feed_state, run_feed


def files(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_numbered_rows_are_appended(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError):
        runs.append_numbered(spark.range(3), root, "t", "2", "id")
    stored = spark.range(50_000).select(F.col("id").alias("k"), F.concat(F.lit("name"), F.col("id").cast("string")).alias("name"), F.lit(0).alias("STT"))
    runs.write_numbered(stored, root, "t", "1", F.desc("k"))
    before = files(root)
    more = spark.range(500).select((F.col("id") + 90_000).alias("k"))
    for _ in range(2):  # the second time nothing is left to do
        runs.append_numbered(more, root, "t", "2", "k")
    after = files(root)
    assert {p: n for p, n in after.items() if p in before} == before
    assert sum(n for p, n in after.items() if p not in before) < 0.1 * sum(before.values())
    got = {r.STT: (r.k, r.name) for r in runs.read_numbered(spark, root, "t").collect()}
    assert sorted(got) == list(range(1, 50_501)) and got[1] == (49_999, "name49999") and got[50_001] == (90_000, None)
    assert runs.read_numbered(spark, root, "t", "1").count() == 50_000
    runs.append_numbered(more.limit(0), root, "t", "3", "k")
    assert runs.read_numbered(spark, root, "t").count() == 50_500
    with pytest.raises(ValueError, match="odd"):
        runs.append_numbered(more.withColumn("odd", F.lit(1)), root, "t", "4", "k")
    assert runs.RunTable(spark, root, "t").versions() == ["1", "2", "3"]


def test_keyed_runs(spark, tmp_path):
    rng, root, wanted = random.Random(2), str(tmp_path), {}
    table = runs.RunTable(spark, root, "s")
    for number in range(14):
        rows = {rng.choice([None, *range(30)]): f"r{number}" for _ in range(0 if number == 6 else 5)}
        wanted |= rows
        df = spark.createDataFrame([(k, v, number) for k, v in rows.items()], "k int, v string, n int").coalesce(1)
        for _ in range(2):
            runs.upsert(df, root, "s", f"{number:03d}", "k", "n", fan_in=3)
        assert {r.k: r.v for r in runs.read_latest(spark, root, "s", "k", "n").collect()} == wanted
        assert len(table.runs()) <= 2 * 3
    assert max(run.level for run in table.runs()) == 2
    assert runs.read_latest(spark, root, "s", "k", "n", "000").count() <= 5
    gone = table.vacuum(keep=1)
    assert gone and len(table.versions()) == 1 and {r.k: r.v for r in runs.read_latest(spark, root, "s", "k", "n").collect()} == wanted


def test_half_written_runs_do_not_count(spark, tmp_path):
    root, df = str(tmp_path), spark.createDataFrame([(1, "a", 0)], "k int, v string, n int")
    table = runs.RunTable(spark, root, "s")
    table.write_run(df.union(df), "001")  # a job that ended before its manifest was there
    assert table.versions() == []
    runs.upsert(df, root, "s", "001", "k", "n")
    assert runs.read_latest(spark, root, "s", "k", "n").count() == table.runs()[0].rows == 1
    table.commit("001", [])
    assert len(table.runs("001")) == 1


def test_a_batch_writes_what_has_changed(spark, tmp_path):
    landed, root, seen = str(tmp_path / "landed"), str(tmp_path / "root"), []
    schema = "id long, rating string, snapshot_at long"
    run = lambda: run_feed(spark, landed, schema, root, str(tmp_path / "ck"), "id", "rating", lambda df, n: seen.append(df.count()))
    size = []
    for number in range(4):
        changed = F.when(F.col("id") % 1_000 == 7 * number, F.lit(f"new {number}")).otherwise(F.sha2(F.col("id").cast("string"), 256))
        spark.range(20_000).select("id", changed.alias("rating"), F.lit(number).cast("long").alias("snapshot_at")).coalesce(1).write.mode("append").parquet(landed)
        run()
        size.append(sum(files(root).values()))
    assert seen[0] == 20_000 and all(n <= 40 for n in seen[1:]) and size[-1] - size[0] < 0.05 * size[0]
    assert {r.id: r.rating for r in feed_state(spark, root, "id").where("id = 21").collect()} == {21: "new 3"} and feed_state(spark, root, "id").count() == 20_000
    assert feed_state(spark, root, "id", "0000000001").where("rating like 'new%'").count() == 20
    assert feed_log(spark, root).count() == sum(seen)

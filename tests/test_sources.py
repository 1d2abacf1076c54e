import json

import pytest
from pyspark.sql import functions as F

from rowloom.sources import readers, writers
from rowloom.streaming.feed import run_feed


def test_jdbc_options():
    options = readers.jdbc_options("jdbc:postgresql://h/d", "t", "u", "p", "id", (1, 100), 4)
    assert options["numPartitions"] == "4" and options["upperBound"] == "100"
    with pytest.raises(ValueError):
        readers.jdbc_options("j", "t", "u", "p", "id")


def test_relation(spark):
    """A scan in ranges from a database within this process, written there first."""
    options = readers.jdbc_options("jdbc:derby:memory:rowloom_test;create=true", "RATINGS", "APP", "x")
    options["driver"] = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    rows = spark.range(100).select(F.col("id").alias("ID"), F.concat(F.lit("r"), F.col("id").cast("string")).alias("RATE"))
    rows.write.format("jdbc").options(**options).save()
    split = options | {k: v for k, v in readers.jdbc_options("", "", "", "", "ID", (0, 100), 4).items() if k not in ("url", "dbtable", "user", "password")}
    got = readers.relation(spark, **split)
    assert got.rdd.getNumPartitions() == 4 and sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))
    found = got.where("ID < 3").select("RATE")
    assert "PushedFilters: [*IsNotNull(ID), *LessThan(ID,3)]" in found._jdf.queryExecution().executedPlan().toString() and found.count() == 3
    with pytest.raises(Exception, match="MISSING"):
        readers.relation(spark, **(options | {"dbtable": "MISSING"}))


def test_catalog(spark):
    spark.range(12).createOrReplaceTempView("numbers_seen")
    assert "numbers_seen" in readers.table_list(spark)
    assert readers.table_columns(spark, "numbers_seen") == [("id", "bigint")]
    assert readers.table_preview(spark, "numbers_seen").count() == 10
    with pytest.raises(ValueError):
        readers.table_columns(spark, "no_such_table")


def test_column_profile(spark):
    odd = spark.createDataFrame([(1, None, None), (2, "", 1.5), (None, "x", None)], "id long, `a.b` string, `c``d` double")
    odd.createOrReplaceTempView("odd_names")
    got = [tuple(r) for r in readers.column_profile(spark, "odd_names").collect()]
    assert got == [("id", 1, "bigint", 3, 2), ("a.b", 2, "string", 3, 2), ("c`d", 3, "double", 3, 1)]
    odd.where("false").createOrReplaceTempView("odd_names")
    assert [r.rows + r.present for r in readers.column_profile(spark, "odd_names").collect()] == [0, 0, 0]
    plan = readers.column_profile(spark, "odd_names")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1


def test_files(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,name\n0123,a\n")
    assert readers.sheet(spark, str(tmp_path / "s.csv"), "id LONG, name STRING", ("id",)).first().id == "0123"
    (tmp_path / "calls.csv").write_text("1,2024-01-01 10:00:00,000,bob,2:0,http://x\n")
    assert readers.call_log(spark, str(tmp_path / "calls.csv")).first().duration == "2:0"
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "1.json").write_text(json.dumps({"records": [{"id": "a", "fields": {"n": 1}}, {"id": "b"}], "offset": "x"}))
    (pages / "2.json").write_text(json.dumps({"other": 1}))
    got = readers.record_pages(spark, str(pages), "struct<id:string,fields:struct<n:int>>").select("id", "fields.n").collect()
    assert sorted(map(tuple, got), key=str) == [("a", 1), ("b", None)]
    (tmp_path / "media").mkdir()
    (tmp_path / "media" / "a.wav").write_bytes(b"1234")
    (tmp_path / "media" / "a.mp4").write_bytes(b"1")
    assert [r.length for r in readers.media_files(spark, str(tmp_path / "media")).collect()] == [4]
    (tmp_path / "links.txt").write_text("1. http://a\njunk\n2. http://b \n")
    assert [tuple(r) for r in readers.numbered_lines(spark, str(tmp_path / "links.txt")).orderBy("n").collect()] == [(1, "http://a"), (2, "http://b")]


def test_versions(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([("a",), ("b",)], "name string")
    with pytest.raises(ValueError):
        writers.read_version(spark, root, "t")
    writers.write_version(df, root, "t", "1")
    writers.write_version(df.limit(1), root, "t", "2")
    assert writers.versions(spark, root, "t") == ["1", "2"]
    assert (writers.read_version(spark, root, "t").count(), writers.read_version(spark, root, "t", "1").count()) == (1, 2)


def test_outputs(spark, tmp_path):
    df = spark.createDataFrame([(1, "child"), (2, "adult")], "id int, final_label string")
    made = writers.write_outputs(df, {"all": lambda d: d, "child": lambda d: d.where("final_label = 'child'")}, str(tmp_path / "o"), "1")
    assert {n: spark.read.parquet(p).count() for n, p in made.items()} == {"all": 2, "child": 1}
    writers.write_by_label(df, str(tmp_path / "l"))
    assert spark.read.parquet(str(tmp_path / "l")).where("final_label = 'adult'").first().id == 2
    writers.write_lines(df, str(tmp_path / "t"), "id", "id")
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == ["1", "2"]
    writers.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    out = str(tmp_path / "sent")
    writers.send_records(df, F.lit(0), ["id"], lambda payload: open(out, "a").write(payload))
    assert open(out).read() == '{"records":[{"fields":{"id":"1"}},{"fields":{"id":"2"}}]}'


def test_feed(spark, tmp_path):
    landed, root, seen = str(tmp_path / "landed"), str(tmp_path / "state"), []
    schema = "id string, rating string, snapshot_at long"
    land = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
    publish = lambda df, n: seen.append(sorted((r.id, r.rating, r.change_type) for r in df.collect()))
    run = lambda: run_feed(spark, landed, schema, root, str(tmp_path / "ck"), "id", "rating", publish)
    land([("a", "1", 1), ("b", "1", 1)])
    run()
    land([("a", "2", 2), ("b", "1", 2), ("c", "1", 2)])
    run()
    land([("a", "1", 3)])
    run()
    assert seen == [[("a", "1", "new"), ("b", "1", "new")], [("a", "2", "changed"), ("c", "1", "new")], [("a", "1", "changed")]]


def test_relation_in_even_ranges(spark):
    """Keys with gaps, a value that a third of the rows share, negative ones and nulls, in a database of this process."""
    options = readers.jdbc_options("jdbc:derby:memory:rowloom_ranges;create=true", "SKEWED", "APP", "x") | {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    keys = [7] * 1_000 + list(range(-500, 500)) + [10**9 + 3 * i for i in range(900)] + [4 * 10**12, None, None, None]
    spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "ID long, N int").repartition(3).write.format("jdbc").options(**options).mode("overwrite").save()
    ranges = readers.key_ranges(spark, "ID", 8, **options)
    assert ranges[-1] == "ID IS NULL" and 8 <= len(ranges) <= 18
    df = readers.relation_in_ranges(spark, "ID", 8, **options)
    assert sorted(r.N for r in df.collect()) == list(range(len(keys)))
    sizes = [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert df.rdd.getNumPartitions() == len(ranges) and sorted(sizes)[-2] <= len(keys) / 8 + 10 and max(sizes) <= 1_100
    none = options | {"dbtable": "(SELECT * FROM SKEWED WHERE N < 0) t0"}
    assert readers.key_ranges(spark, "ID", 8, **none) == ["1 = 1"] and readers.relation_in_ranges(spark, "ID", 8, **none).count() == 0
    one = options | {"dbtable": "(SELECT * FROM SKEWED WHERE N < 100) t1"}
    assert readers.key_ranges(spark, "ID", 8, **one) == ["ID IS NOT NULL"]


def test_catalog_table_in_even_ranges(spark, tmp_path):
    """A table of Spark's catalog gets the conditions that a database gives for the same keys; keys may be as far apart as
    whole numbers are."""
    options = readers.jdbc_options("jdbc:derby:memory:rowloom_both;create=true", "BOTH_KEYS", "APP", "x") | {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    keys = [7] * 1_000 + list(range(-500, 500)) + [10**9 + 3 * i for i in range(900)] + [4 * 10**12, None, None, None]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "ID long, N int")
    rows.write.format("jdbc").options(**options).mode("overwrite").save()
    writers.write_by_key(rows, str(tmp_path / "t"), "ID")
    spark.read.schema(rows.schema).parquet(str(tmp_path / "t")).createOrReplaceTempView("stored_keys")
    assert readers.key_ranges(spark, "ID", 8, dbtable="stored_keys") == readers.key_ranges(spark, "ID", 8, **options)
    assert sorted(r.N for r in readers.relation_in_ranges(spark, "ID", 8, dbtable="stored_keys").collect()) == list(range(len(keys)))
    assert readers.relation_in_ranges(spark, "ID", 8, dbtable="(SELECT * FROM stored_keys WHERE N < 0) t0").count() == 0
    far = [-(2**63), -(2**63) + 1, *range(2**53, 2**53 + 1_000), 2**63 - 1, None]
    spark.createDataFrame([(k, i) for i, k in enumerate(far)], "ID long, N int").createOrReplaceTempView("far_keys")
    got = readers.relation_in_ranges(spark, "ID", 4, dbtable="far_keys")
    assert sorted(r.N for r in got.collect()) == list(range(len(far)))
    sizes = [spark.table("far_keys").where(condition).count() for condition in readers.key_ranges(spark, "ID", 4, dbtable="far_keys")]
    assert sum(sizes) == len(far) and len(sizes) >= 5 and max(sizes) <= len(far) / 4 + 10
    for name in ("stored_keys", "far_keys"):
        spark.catalog.dropTempView(name)

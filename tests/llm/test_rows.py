"""Places of rows, and the filter that spares rows a shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from rowloom.llm import rows


@pytest.mark.parametrize("per_key, most", [(1, 1 << 20), (12, 1 << 20), (12, 2)])
def test_without_is_exact_however_full_the_filter_is(spark, monkeypatch, per_key, most):
    monkeypatch.setattr(rows, "BITS_PER_KEY", per_key)
    monkeypatch.setattr(rows, "MOST_WORDS", most)
    rng = random.Random(per_key)
    keys = [rng.randrange(400) for _ in range(1500)]
    gone = {rng.randrange(500) for _ in range(120)}
    df = spark.createDataFrame([(k, f"v{i}") for i, k in enumerate(keys)], "k long, v string")
    named = spark.createDataFrame([(k,) for k in gone], "k long")
    left = rows.without(df, "k", named)
    assert left.columns == df.columns
    assert sorted(map(tuple, left.collect())) == sorted((k, f"v{i}") for i, k in enumerate(keys) if k not in gone)
    found = rows.filter_of(named, "k")
    assert (found.table is None) == (most == 2) and (found.table is None or found.table.count() <= found.words <= most)
    passed = {r.k for r in rows.passing(df, "k", found).collect()}
    assert passed >= gone & set(keys) and {r.k for r in rows.passing(df, "k", found, others=True).collect()} == set(keys) - passed
    none = spark.createDataFrame([], "k long")
    assert rows.without(df, "k", none).count() == len(keys) and rows.without(df.limit(0), "k", none).count() == 0


def test_few_other_rows_pass_at_any_number_of_keys(spark):
    """The filter grows with its keys up to its bound, and there is none beyond."""
    for n in (1, 300, 20_000):
        found = rows.filter_of(spark.range(n).withColumnRenamed("id", "k"), "k")
        others = spark.range(10**6, 10**6 + 50_000).withColumnRenamed("id", "k")
        assert rows.passing(others, "k", found).count() < 0.04 * 50_000
    assert rows.words_for(5_500_000) == rows.MOST_WORDS and rows.words_for(50_000_000) == 0


def test_places_name_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select("id", F.lit("x").alias("_metadata"), F.lit(1).alias("file")).repartition(4).write.parquet(path)
    docs = rows.located(spark.read.parquet(path).where("id % 2 = 0").withColumn("more", F.lit(1)))
    placed = docs.select("id", rows.place(docs).alias("p"), rows.row_key(docs).alias("k"))
    first, again = (sorted(map(tuple, placed.collect())) for _ in range(2))
    assert first == again and len({p for _, p, _ in first}) == len({bytes(k) for _, _, k in first}) == 500
    both = rows.located(docs.union(docs))  # rows of one place twice: written anew, so that each has its own
    assert both.select(rows.row_key(both)).distinct().count() == both.count() == 1000

"""Plans that have to stay what they are."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rowloom.functions import jsonx
from rowloom.operators import index, ingest

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["rating_changes", "rated_run_rows", "incremental_first", "state_latest", "keyed_update", "flatten_payload", "section_windows", "cell_copy"])
def test_no_cross_join_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert not any(word in text for word in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "Arrow"))


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["rating_projection"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in text
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,props:string>" in text


def test_latest_is_an_aggregate(spark):
    df = spark.read.parquet(f"{SF}/events.parquet")
    text = plan(index.latest_by(df.select("user_id", "event_id", "value"), "user_id", "event_id"))
    assert "Window" not in text and text.count("Exchange") == 1


def test_anti_join_is_one_shuffle_each(spark):
    """Either side is shuffled once by its key, and what is stored once more at most to make its keys distinct."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.read.parquet(f"{SF}/events.parquet")
        text = plan(ingest.new_keys(df, df.where(F.col("event_id") < 10), "user_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in text and 2 <= text.count("Exchange hashpartitioning") <= 3 and text.count("Exchange") == text.count("Exchange hashpartitioning")


def test_an_answers_block_is_worked_out_once(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    text = plan(jsonx.answer_items(df, "text", "doc_id"))
    # one block, one check of the body; the other check is that of each item
    assert text.count("regexp_extract") == 1 and text.count("parseJson") == 2 and text.count("from_json") == 1

"""Registered queries against their DuckDB SQL on the smallest tables, and the entry module without its optional part."""

import glob
import math
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pyspark
import pytest

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    if isinstance(value, bool):
        return str(int(value))
    return f"{value:.9g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    wanted = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(wanted.columns)
    got = sorted(tuple(plain(row[c]) for c in sorted(df.columns)) for row in df.collect())
    places = [wanted.columns.index(c) for c in sorted(wanted.columns)]
    assert got == sorted(tuple(plain(row[i]) for i in places) for row in wanted.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["event_id", "rating", "change_type"]


def test_without_the_optional_part(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True, text=True)
    assert out.stdout.split() == [str(len(entry.records.QUERIES)), "False"], out.stderr


def test_relation_scan_on_executors(con, tmp_path):
    """relation_scan where executors are other processes and no database is named."""
    home = tmp_path / "home"  # executors log to a folder of Spark's home
    (home / "work").mkdir(parents=True)
    for p in Path(pyspark.__file__).parent.iterdir():
        if p.name != "work":
            (home / p.name).symlink_to(p)
    code = f"""
from pyspark.sql import SparkSession
conf = {{"spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "1g", "spark.checkpoint.dir": "file://{tmp_path}/shared", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.host": "127.0.0.1"}}
spark = SparkSession.builder.config(map=conf).getOrCreate()
import __spark_entry__ as e
e.queries()["relation_scan"](spark, "{SF}").write.parquet("{tmp_path}/out")
print("tables left", [t.name for t in spark.catalog.listTables()])
"""
    env = os.environ | {"PYTHONPATH": ROOT, "SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "tables left []" in out.stdout, out.stderr[-2000:]
    got, sql = f"SELECT id, split_key, amount FROM '{tmp_path}/out/*.parquet'", entry.oracle_sql()["relation_scan"]
    assert con.sql(f"(({got}) EXCEPT ALL ({sql})) UNION ALL (({sql}) EXCEPT ALL ({got}))").fetchall() == []
    assert con.sql(f"SELECT count(*) FROM ({got})").fetchall() == con.sql(f"SELECT count(*) FROM ({sql})").fetchall()

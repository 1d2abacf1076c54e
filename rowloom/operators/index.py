"""Row numbers, batches and first rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.sources.shared import reused


def dense_index(df: DataFrame, *order: Column | str, name: str = "rn", buckets: int | None = None) -> DataFrame:
    """df with row numbers from 1 in the given order, without a window over all rows in one task.

    Rows are ranged over `buckets` by all columns of the order, numbered within their bucket, and moved on by the sizes of
    the buckets before, of which there are `buckets` at most: by default the session's number of shuffle partitions,
    which is set to suit the input, and 64 at least. `order` has to settle ties; so a value that most rows hold in its
    first columns is spread over buckets by the others."""
    buckets = buckets or max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = reused(df.repartitionByRange(buckets, *columns).withColumn("_bucket", F.spark_partition_id()))
    sizes = ranged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(F.col("_bucket").alias("_of"), (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_bucket").orderBy(*columns))
    # one row per bucket: bounded by `buckets`
    joined = ranged.join(F.broadcast(before), F.col("_bucket") == F.col("_of"))
    return joined.withColumn(name, own + F.col("_before")).drop("_bucket", "_of", "_before")


def batches(df: DataFrame, size: int, *order: Column | str, after: int = 0) -> DataFrame:
    """dense_index with batch_no from 0; `after`: the last row number that is done, rows up to it are left out."""
    rows = dense_index(df, *order)
    return rows.where(F.col("rn") > after).withColumn("batch_no", F.floor((F.col("rn") - 1) / size).cast("long"))


def append_renumbered(stored: DataFrame, more: DataFrame, *order: str, name: str = "STT") -> DataFrame:
    """Stored rows, then new ones, numbered from 1. `order` settles the order within each."""
    both = stored.drop(name).withColumn("_new", F.lit(0)).unionByName(more.drop(name).withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return dense_index(both, "_new", *order, name=name).drop("_new")


def latest_by(df: DataFrame, key: str, version: str) -> DataFrame:
    """The row of each key with the greatest version, by an aggregation that combines on the map side."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_row"))
    return best.select(key, *(F.col(f"_row.{c}").alias(c) for c in rest)).select(*df.columns)


def first_by(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key in the given order, which has to settle ties; a null key is a key."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(key, *(F.col(f"_row.{c}").alias(c) for c in rest)).select(*df.columns)

"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowloom.sources.shared import scratch, shared_dir

__all__ = ["clean", "scratch", "shared_dir", "table", "written"]


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """df as a table in the shared folder: it is computed once, its lineage ends there and a lost executor costs no
    recomputation of what came before."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> None:
    """Remove everything that `scratch` has handed out below the shared folder. Results that are still to be read from
    there are lost, so save them first; other jobs that share the folder must have ended."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/rowloom")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

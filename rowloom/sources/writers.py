"""Sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions.jsonx import record_payload


def versions(spark: SparkSession, root: str, name: str) -> list[str]:
    """Versions of a table under root, oldest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName()[2:] for s in fs.listStatus(path) if s.getPath().getName().startswith("v="))


def write_version(df: DataFrame, root: str, name: str, version: str) -> str:
    """df as a new version of a table; earlier ones stay, so nothing has to be backed up first."""
    path = f"{root}/{name}/v={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def read_version(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """A version of a table, the latest by default; a table without one is an error."""
    have = versions(spark, root, name)
    if not have or (version and version not in have):
        raise ValueError(f"no version {version or ''} of {name} under {root}")
    return spark.read.parquet(f"{root}/{name}/v={version or have[-1]}")


def write_outputs(df: DataFrame, outputs: dict[str, Callable[[DataFrame], DataFrame]], root: str, version: str) -> dict[str, str]:
    """Several named tables out of one source, which is computed once."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {name: write_version(make(df), root, name, version) for name, make in outputs.items()}
    finally:
        df.unpersist()


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def write_lines(df: DataFrame, path: str, column: str, *order: str) -> None:
    """One line per row, files and lines in the given order."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).select(F.col(column).cast("string").alias("value")).write.mode("errorifexists").text(path)


def write_by_key(df: DataFrame, path: str, *order: str) -> None:
    """Rows stored where they lie, each file in the order of a key: a scan of a range of it skips a file's other pages, and no
    value is too frequent, as nothing is shuffled."""
    df.sortWithinPartitions(*order).write.mode("errorifexists").parquet(path)


def write_by_label(df: DataFrame, path: str, label: str = "final_label") -> None:
    df.write.mode("errorifexists").partitionBy(label).parquet(path)


def send_records(df: DataFrame, batch: Column, columns: list[str], send: Callable[[str], None], null_text: str | None = "None") -> None:
    """Payloads of the rows' batches, given to `send` where they lie. A failure fails the job, so whoever keeps state
    writes it after this returns. A retried task sends its payloads again."""

    def each(rows: Iterator) -> None:
        for row in rows:
            send(row["payload"])

    record_payload(df, batch, *columns, null_text=null_text).foreachPartition(each)

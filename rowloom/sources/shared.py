"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only where that is unset and all of Spark is one process, as in tests, a
    temporary one; executors elsewhere would not see that."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not (master := spark.sparkContext.master).startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/rowloom/{label}-{uuid.uuid4().hex}"


def reused(df: DataFrame) -> DataFrame:
    """df for two passes that must see the same rows in the same partitions: a checkpoint in the shared folder where one
    is set, which Spark's cleaner removes; else kept in memory and on disk until the cache is cleared."""
    if df.sparkSession.sparkContext.getCheckpointDir():
        return df.checkpoint()
    return df.persist(StorageLevel.MEMORY_AND_DISK)

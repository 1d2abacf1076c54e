"""The poll-and-diff job over a stream of landed snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.operators.changes import new_or_changed
from rowloom.operators.index import latest_by
from rowloom.sources.runs import RunTable, read_latest, upsert


def run_feed(spark: SparkSession, landed: str, schema, root: str, checkpoint: str, key: str, tracked: str, publish: Callable[[DataFrame, int], None], files_per_batch: int = 1, history: bool = True) -> None:
    """Take every snapshot file that has landed since the last run, publish its new and changed records and then add
    them to the state, a keyed table of runs under root (see `feed_state`): a batch writes what has changed and its share
    of merging runs, not the state. State advances only after publish has returned, and a batch that is tried again is
    diffed against the state before it and writes nothing twice: its version is its number. files_per_batch: where
    snapshots have several files, how many of them are diffed at once; within a batch the latest row of a key counts.
    history: whether the state keeps what records were before (see `feed_log`)."""
    table = RunTable(spark, root, "state")

    def batch(df: DataFrame, number: int) -> None:
        version = f"{number:010d}"
        have = [v for v in table.versions() if v < version]
        current = latest_by(df, key, "snapshot_at").drop("snapshot_at")
        if have:
            stored = read_latest(spark, root, "state", key, "version", have[-1])
        else:
            stored = current.limit(0).withColumn("version", F.lit(0).cast("long"))
        changed = new_or_changed(current, stored, key, tracked).persist()
        publish(changed, number)
        upsert(changed.drop("change_type").withColumn("version", F.lit(number).cast("long")), root, "state", version, key, "version", history=history)
        changed.unpersist()

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landed)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def feed_state(spark: SparkSession, root: str, key: str, version: str | None = None) -> DataFrame:
    """The latest row of each record after a batch, by default the last one; `version` is the batch that wrote it."""
    return read_latest(spark, root, "state", key, "version", version)


def feed_log(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """All that the state holds: with history, every new and changed row ever taken."""
    return RunTable(spark, root, "state").read(version)

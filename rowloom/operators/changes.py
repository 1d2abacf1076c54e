"""Change feed of ratings.

The tracked field is compared with the latest stored version of its record, null-safely. (Comparing with the first
stored row instead would report a changed record again on every run and never report a change back.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.jsonx import is_json, json_has_key, json_text
from rowloom.operators.index import latest_by


def rated_rows(log: DataFrame, metadata: str, key: str = "rate", condition: Column | None = None) -> DataFrame:
    """Rows whose metadata has the key at top level."""
    rows = log if condition is None else log.where(condition)
    return rows.where(json_has_key(F.col(metadata), key))


def rating_projection(log: DataFrame, metadata: str, paths: dict[str, tuple[str, ...]], *ids: str) -> DataFrame:
    """The id columns and, as text, the values under the given JSON keys."""
    return log.select(*ids, *(json_text(F.col(metadata), *keys).alias(name) for name, keys in paths.items()))


def rows_of_runs(log: DataFrame, chosen: DataFrame, run: str) -> DataFrame:
    """All rows of the runs that have a chosen row."""
    return log.join(chosen.select(run).distinct(), run, "left_semi")


def new_or_changed(current: DataFrame, stored: DataFrame, key: str, tracked: str, version: str | None = None) -> DataFrame:
    """current rows with change_type `new` (no stored row of that key) or `changed` (the tracked field differs as text
    from the latest stored version). One join; stored holds a row per key unless version tells which is the latest."""
    latest = latest_by(stored, key, version) if version else stored
    old = latest.select(F.col(key).alias("_key"), F.col(tracked).cast("string").alias("_old"))
    joined = current.join(old, current[key] == old["_key"], "left")
    change = F.when(F.col("_key").isNull(), "new").when(~F.col("_old").eqNullSafe(current[tracked].cast("string")), "changed")
    return joined.withColumn("change_type", change).where("change_type IS NOT NULL").select(*(current[c] for c in current.columns), "change_type")


def changed_json(current: DataFrame, stored: DataFrame, key: str, metadata: str, *keys: str) -> DataFrame:
    """Rows on both sides whose field under a JSON path differs; a side that does not parse is skipped."""
    old = stored.where(is_json(F.col(metadata))).select(F.col(key).alias("_key"), json_text(F.col(metadata), *keys).alias("_old"))
    rows = current.where(is_json(F.col(metadata)))
    joined = rows.join(old, rows[key] == old["_key"])
    return joined.where(~F.col("_old").eqNullSafe(json_text(rows[metadata], *keys))).select(*(rows[c] for c in rows.columns))

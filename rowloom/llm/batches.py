"""Arrow batches inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows handled at once: long texts make larger slices costly.
ROWS = 512


def sliced(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`; empty ones are left out. What Arrow holds in reserve is given back
    after the last one, and so is what the C library has: the worker lives on for other stages."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        trim(0)


def texts(column: pa.Array) -> list[str]:
    """Strings of a column, null as the empty string."""
    return [text or "" for text in column.to_pylist()]


def lean(spark: SparkSession) -> None:
    """Batches for Python workers of 2,000 rows and 16 MB at most: whole texts make rows of kilobytes, and Spark's
    defaults take tens of megabytes on either side. Settings of the session's own stay."""
    for name, default, value in (("maxRecordsPerBatch", "10000", "2000"), ("maxBytesPerBatch", "67108864b", "16m")):
        if spark.conf.get(f"spark.sql.execution.arrow.{name}") == default:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", value)

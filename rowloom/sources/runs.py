"""Tables kept as runs of files: a version names the runs it consists of, so that what is added costs what is added.

`<root>/<name>/runs/<id>` holds a run's Parquet files; `<root>/<name>/manifest/<version>` lists the runs of a version, one JSON
line each, oldest first. A manifest is written beside its place and renamed, so a version is there whole or not at all; a
job that is tried again finds its version and adds nothing, and what a failed one has left is written over. Runs are not
changed once they are listed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.operators.index import dense_index, latest_by

#: Runs of a level of a keyed table that are merged into one of the next level.
FAN_IN = 8


@dataclass(frozen=True)
class Run:
    id: str
    rows: int
    level: int = 0


class RunTable:
    """The versions of a table under root, listed through Hadoop's file system, wherever root is."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/{name}"
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, below: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{below}" if below else self.path)

    def _names(self, below: str) -> list[str]:
        path = self._at(below)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def versions(self) -> list[str]:
        """Oldest first: versions sort as text."""
        return [name for name in self._names("manifest") if not name.startswith(("_", "."))]

    def runs(self, version: str | None = None) -> list[Run]:
        """The runs of a version, the latest by default; a table without one is an error."""
        have = self.versions()
        if not have or (version and version not in have):
            raise ValueError(f"no version {version or ''} of {self.path}")
        stream = self._fs.open(self._at(f"manifest/{version or have[-1]}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [Run(**json.loads(line)) for line in text.splitlines()]

    def write_run(self, df: DataFrame, run: str, level: int = 0) -> Run:
        """df as a run, its rows counted from the files' footers."""
        path = f"{self.path}/runs/{run}"
        df.write.mode("overwrite").parquet(path)
        return Run(run, self.spark.read.parquet(path).count(), level)

    def commit(self, version: str, runs: list[Run]) -> None:
        """The version with these runs; one that is there already stays."""
        if version in self.versions():
            return
        draft, place = self._at(f"manifest/_{uuid.uuid4().hex}"), self._at(f"manifest/{version}")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray("".join(json.dumps(asdict(run)) + "\n" for run in runs).encode()))
        finally:
            out.close()
        if not self._fs.rename(draft, place):
            self._fs.delete(draft, False)
            if version not in self.versions():
                raise OSError(f"no manifest at {place}")

    def read(self, version: str | None = None, runs: list[Run] | None = None) -> DataFrame:
        """All rows of a version's runs, or of the given ones."""
        runs = self.runs(version) if runs is None else runs
        return self.spark.read.parquet(*(f"{self.path}/runs/{run.id}" for run in runs))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove all but the last `keep` versions and the runs that only those name, and return these runs. Readers of
        older versions must have ended."""
        have = self.versions()
        gone, kept = have[: max(0, len(have) - keep)], have[max(0, len(have) - keep) :]
        used = {run.id for version in kept for run in self.runs(version)}
        listed = {run.id for version in gone for run in self.runs(version)}
        for version in gone:
            self._fs.delete(self._at(f"manifest/{version}"), False)
        for run in sorted(listed - used):
            self._fs.delete(self._at(f"runs/{run}"), True)
        return sorted(listed - used)


# --- numbered tables: rows are appended ------------------------------------------------------------------------------

def write_numbered(df: DataFrame, root: str, name: str, version: str, *order: Column | str, number: str = "STT") -> None:
    """df, numbered from 1 in the given order (which has to settle ties), as a version of a new table."""
    table = RunTable(df.sparkSession, root, name)
    if version not in table.versions():
        table.commit(version, [table.write_run(dense_index(df.drop(number), *order, name=number), version)])


def append_numbered(df: DataFrame, root: str, name: str, version: str, *order: Column | str, number: str = "STT") -> None:
    """df appended to the latest version, numbered on from its last row. Stored rows are neither read nor written: how many
    there are is in the manifest. Columns are matched by name: those that df lacks are null, others that the table lacks
    are an error. A table that is not there is an error; a version that is there is left as it is."""
    table = RunTable(df.sparkSession, root, name)
    if version in table.versions():
        return
    stored = table.runs()
    columns = table.read(runs=stored[:1]).schema
    if unknown := set(df.columns) - {f.name for f in columns}:
        raise ValueError(f"columns that {name} lacks: {', '.join(sorted(unknown))}")
    numbered = dense_index(df.drop(number), *order, name=number)
    numbered = numbered.withColumn(number, F.col(number) + sum(run.rows for run in stored))
    same = numbered.select(*((F.col(f.name) if f.name in numbered.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in columns))
    table.commit(version, [*stored, table.write_run(same, version)])


def read_numbered(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    return RunTable(spark, root, name).read(version)


# --- keyed tables: rows are replaced ---------------------------------------------------------------------------------

def upsert(df: DataFrame, root: str, name: str, version: str, key: str, by: str, fan_in: int = FAN_IN, history: bool = False) -> None:
    """Rows that take the place of those with the same key, as a new version. `by` tells which row of a key is the latest
    (see `read_latest`); df has one row for each key.

    df alone is written, as a run of level 0. When a level has `fan_in` runs they are merged into one of the next level, and
    of their rows the latest per key stays (with history, all of them): a row is rewritten once a level, of which there are as many as powers of
    fan_in in the number of versions, however large the table is."""
    table = RunTable(df.sparkSession, root, name)
    have = table.versions()
    if version in have:
        return
    runs, fresh = table.runs() if have else [], table.write_run(df, version)
    runs = [*runs, fresh] if fresh.rows or not runs else runs
    level = 0
    while len(full := [run for run in runs if run.level == level]) >= fan_in:
        rows = table.read(runs=full)
        merged = table.write_run(rows if history else latest_by(rows, key, by), f"{version}-{level + 1}", level + 1)
        runs, level = [run for run in runs if run.level > level] + [merged], level + 1
    table.commit(version, runs)


def read_latest(spark: SparkSession, root: str, name: str, key: str, by: str, version: str | None = None) -> DataFrame:
    """The latest row of each key: runs merged while they are read, by an aggregation that combines on the map side."""
    return latest_by(RunTable(spark, root, name).read(version), key, by)

"""Cutting lineage and keeping snapshots in folders that all executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> None:
    """Checkpoints go to spark.checkpoint.dir; where that is unset, a local session has a temporary folder and a cluster an error: its executors share no such folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="fragloom-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)


def materialise(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder: a lost executor costs no recomputation."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


class Snapshots:
    """A table as numbered Parquet snapshots under one folder; readers see the last complete one.

    A snapshot counts once its writer has left the _SUCCESS file, so a rebuild is atomic for readers
    and a failed one leaves the table as it was.  Writing a number again replaces that snapshot.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def numbers(self) -> list[int]:
        """Complete snapshots, ascending."""
        root = self._path(self.folder)
        if not self._fs.exists(root):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(root)]
        found = [int(m[1]) for m in (re.fullmatch(r"v=(\d+)", x) for x in names) if m]
        return sorted(n for n in found if self._fs.exists(self._path(f"{self.folder}/v={n}/_SUCCESS")))

    def read(self, before: int | None = None) -> DataFrame | None:
        """The last snapshot (with a number below ``before``), or None."""
        numbers = [n for n in self.numbers() if before is None or n < before]
        return self.spark.read.parquet(f"{self.folder}/v={numbers[-1]}") if numbers else None

    def write(self, df: DataFrame, number: int | None = None) -> int:
        number = max(self.numbers(), default=-1) + 1 if number is None else number
        df.write.mode("overwrite").parquet(f"{self.folder}/v={number}")
        return number

    def prune(self, keep: int = 2) -> None:
        """Drop all but the last ``keep`` snapshots."""
        for n in self.numbers()[:-keep]:
            self._fs.delete(self._path(f"{self.folder}/v={n}"), True)


class SnapshotSet:
    """Several tables that readers see change together: numbered folders with one Parquet folder for each table.

    A set counts once all its tables are written and its _SUCCESS file is there, which is made last.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.versions = Snapshots(spark, folder)

    def write(self, tables: dict[str, DataFrame]) -> int:
        number = max(self.versions.numbers(), default=-1) + 1
        folder = f"{self.versions.folder}/v={number}"
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{folder}/{name}")
        self.versions._fs.create(self.versions._path(f"{folder}/_SUCCESS"), True).close()
        return number

    def read(self, name: str) -> DataFrame | None:
        """A table of the last complete set, or None."""
        numbers = self.versions.numbers()
        return self.versions.spark.read.parquet(f"{self.versions.folder}/v={numbers[-1]}/{name}") if numbers else None

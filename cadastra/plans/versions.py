"""Tables of versions and a ledger of runs, safe on file systems without an atomic rename.

Data goes to a folder that nobody reads yet. An empty marker file, made last, commits it: a file is there or it is not,
on an object store too. Readers list the markers and take the newest, so a writer that dies at any step leaves them the
version before.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.plans.warehouse import Warehouse
from cadastra.shared import remove_path


def _system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no such folder."""
    system, folder = _system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []


def _mark(spark: SparkSession, path: str) -> None:
    system, file = _system(spark, path)
    system.create(file, False).close()


class VersionedWarehouse(Warehouse):
    """A warehouse whose tables are folders of versions; published tables are never written over.

    One writer per table at a time. A reader that holds a version may finish with it until it is collected.
    """

    def _table(self, name: str) -> str:
        return super().path(name).removesuffix(".parquet")

    def versions(self, name: str) -> list[str]:
        """Committed versions, oldest first."""
        return _names(self.spark, f"{self._table(name)}/committed")

    def path(self, name: str) -> str:
        """The folder of the newest committed version."""
        committed = self.versions(name)
        if not committed:
            raise FileNotFoundError(f"{self._table(name)} has no committed version")
        return f"{self._table(name)}/data/{committed[-1]}"

    def publish(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> int:
        """Write the next version and commit it; returns its row count. ``df`` may read the version before."""
        committed = self.versions(name)
        number = int(committed[-1].split("-")[0]) + 1 if committed else 1
        version = f"{number:012d}-{uuid.uuid4().hex}"
        rows = self._write(f"{self._table(name)}/data/{version}", df, partition_by)
        self._commit(name, version)
        return rows

    replace = publish

    def _commit(self, name: str, version: str) -> None:
        _mark(self.spark, f"{self._table(name)}/committed/{version}")

    def collect(self, name: str, keep: int = 2) -> int:
        """Delete all versions but the newest ``keep``, and what was never committed; returns how many went.

        Markers go before their data, so a version that can be found is whole.
        """
        committed = self.versions(name)
        kept = committed[-max(keep, 1):]
        for version in committed:
            if version not in kept:
                remove_path(self.spark, f"{self._table(name)}/committed/{version}")
        # A version newer than the newest committed one may be in the making.
        old = [v for v in _names(self.spark, f"{self._table(name)}/data") if v not in kept and kept and v <= kept[-1]]
        for version in old:
            remove_path(self.spark, f"{self._table(name)}/data/{version}")
        return len(old)


class RunLedger:
    """What each run kept, read and rejected, and how long it took: one entry per run id, however often it is sent."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _runs(self) -> dict[str, str]:
        """The folder of each run: that of its first marker, where a run was sent at the same time twice."""
        found: dict[str, str] = {}
        for marker in _names(self.spark, f"{self.root}/committed"):
            found.setdefault(marker.rsplit("--", 1)[0], marker)
        return found

    def record(self, run_id: str, audit: DataFrame) -> bool:
        """Add a run's audit (table_name, kept_rows, raw_rows, seconds); False if the run is known already."""
        if not re.fullmatch(r"[A-Za-z0-9_.:-]+", run_id) or "--" in run_id:
            raise ValueError("a run id is letters, digits and _ . : - without two dashes in a row")
        if run_id in self._runs():
            return False
        entry = f"{run_id}--{uuid.uuid4().hex}"
        audit.select(
            F.lit(run_id).alias("run_id"), "table_name", "kept_rows", "raw_rows",
            (F.col("raw_rows") - F.col("kept_rows")).alias("rejected_rows"), F.col("seconds").cast("double").alias("seconds"),
        ).write.parquet(f"{self.root}/data/{entry}")
        _mark(self.spark, f"{self.root}/committed/{entry}")
        return True

    def history(self) -> DataFrame:
        """All entries of all runs."""
        schema = "run_id string, table_name string, kept_rows bigint, raw_rows bigint, rejected_rows bigint, seconds double"
        paths = [f"{self.root}/data/{entry}" for entry in self._runs().values()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

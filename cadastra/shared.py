"""Session set-up and the shared folder that holds staged tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SETTING, _OWN = "spark.checkpoint.dir", "cadastra.scratch.dir"
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def build_session(app: str = "cadastra", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did."""
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset, ``cadastra.scratch.dir`` may name one during a session. Only a local master may
    go without either: it gets a fresh folder of its own, the same for the whole session.
    """
    folder = spark.conf.get(_SETTING, None) or spark.conf.get(_OWN, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} or {_OWN} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="cadastra-")
    spark.conf.set(_OWN, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    made = _scope.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, what was staged inside; write the results that need it before."""
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in made:
            remove_path(spark, path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Let the shuffle files of what is run inside go when it ends, not when the driver collects its garbage.

    A data frame that is run twice makes its shuffles anew. For one thread at a time, as the setting is the session's.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_DROP_SHUFFLES) if before is None else spark.conf.set(_DROP_SHUFFLES, before)


def stage(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write ``df`` once and return it as a scan of what was written.

    Cuts the lineage so that a lost executor costs one scan task and not the whole plan, lets later
    passes read only the columns they need, and gives the optimizer a real size: a small staged
    table is broadcast by Spark's own size check, and a large one is not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop file system it lives on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

"""What the operators of this subpackage share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The six white-space characters that separate words: space and 0x09 to 0x0D.
SPACES = " \t\n\x0b\f\r"
WORD_GAP = r"[\x20\x09-\x0D]+"

# Rows per Arrow batch: texts may be long, and a batch is held whole by a Python worker.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, and workers that import this package from where the driver did."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's own reader."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text as an array; none for a null."""
    pieces = F.split(F.coalesce(text, F.lit("")), WORD_GAP)
    return F.filter(pieces, lambda word: word != "")


def let(value: Column, body) -> Column:
    """``body`` applied to ``value``, which is evaluated once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hex_of(fingerprint: Column) -> Column:
    """A long as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))

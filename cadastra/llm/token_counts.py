"""Token totals by source, language and tokenizer version, maintained from signed changes.

A change carries the old and the new count of a document under a tokenizer version: an insert has no
old count, a delete no new one, a revision both. A batch of changes becomes one small table of additive
differences, which a rename publishes under its batch id. A batch that is committed already is skipped,
so a repeated or resumed run adds nothing.

Totals are the newest snapshot plus the batches committed since; they never need the documents again.
:meth:`TokenRollup.compact` rolls those batches up into the next snapshot. A snapshot lists the batches it holds and
is committed by an empty marker file made last, so a run killed at any step leaves totals as they were. What a
snapshot has made needless is deleted one snapshot later, so readers may finish; of a batch its ``_SUCCESS`` file
stays, by which the batch is known as committed.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.plans.versions import _mark, _names
from cadastra.shared import remove_path

KEYS = ("source", "lang", "tokenizer")
_SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def differences(changes: DataFrame) -> DataFrame:
    """Additive differences of (source, lang, tokenizer, old_tokens, new_tokens); nulls are keys too.

    Partial sums are taken before the shuffle, so a source with a third of all rows costs one row per task.
    """
    change = F.col("new_tokens").isNotNull().cast("long") - F.col("old_tokens").isNotNull().cast("long")
    tokens = F.coalesce("new_tokens", F.lit(0)) - F.coalesce("old_tokens", F.lit(0))
    return changes.groupBy(*KEYS).agg(
        F.sum(change).alias("n_docs"), F.sum(tokens).cast("long").alias("n_tokens")
    )


class TokenRollup:
    """Committed batches of differences, and snapshots of their totals, in a folder that all executors share.

    Any number of writers may commit batches, one at a time may compact.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _fs(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _batch(self, batch_id: str) -> str:
        if not batch_id.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"not a batch id: {batch_id!r}")
        return f"{self.folder}/batches/batch={batch_id}"

    def committed(self, batch_id: str) -> bool:
        fs, target = self._fs(self._batch(batch_id))
        return fs.exists(target)

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch; False, and nothing done, if a batch of this id is committed."""
        if self.committed(batch_id):
            return False
        written = f"{self.folder}/open/{batch_id}-{uuid.uuid4().hex}"
        differences(changes).write.option("compression", "zstd").parquet(written)
        fs, target = self._fs(self._batch(batch_id))
        fs.mkdirs(target.getParent())
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
        try:
            context.rename(self._fs(written)[1], target, options)
        except Py4JJavaError:
            if not fs.exists(target):
                raise
            remove_path(self.spark, written)  # another run of this batch was first
            return False
        return True

    def snapshots(self) -> list[str]:
        """Committed snapshots, oldest first."""
        return _names(self.spark, f"{self.folder}/snapshots")

    def _held(self, snapshot: str) -> set[str]:
        """Ids of the batches in a snapshot."""
        rows = self.spark.read.schema("batch string").parquet(f"{self.folder}/rolled/{snapshot}/held").collect()
        return {row["batch"] for row in rows}

    def _state(self) -> tuple[DataFrame, set[str]]:
        """Totals, and the ids of the batches in them: those of the newest snapshot and those committed since."""
        newest = self.snapshots()[-1:]
        held = self._held(newest[0]) if newest else set()
        since = {name.removeprefix("batch=") for name in _names(self.spark, f"{self.folder}/batches")} - held
        paths = [f"{self.folder}/rolled/{name}/totals" for name in newest] + [self._batch(name) for name in sorted(since)]
        if not paths:
            return self.spark.createDataFrame([], _SCHEMA), set()
        # Each path is a whole table; the folder's name is no column of it.
        added = self.spark.read.schema(_SCHEMA).parquet(*paths)
        summed = added.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return summed.where("n_docs <> 0 OR n_tokens <> 0"), held | since

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over all committed batches; spent keys go."""
        return self._state()[0]

    def compact(self) -> bool:
        """Roll the batches since the newest snapshot up into the next; False, and nothing done, if there are none."""
        before = self.snapshots()
        totals, held = self._state()
        old = self._held(before[-1]) if before else set()
        if held == old:
            return False
        number = int(before[-1].split("-")[0]) + 1 if before else 1
        name = f"{number:012d}-{uuid.uuid4().hex}"
        totals.coalesce(1).write.option("compression", "zstd").parquet(f"{self.folder}/rolled/{name}/totals")
        listed = self.spark.createDataFrame([(batch,) for batch in sorted(held)], "batch string")
        listed.coalesce(1).write.parquet(f"{self.folder}/rolled/{name}/held")
        self._publish(name)
        self._clean(before, old)
        return True

    def _publish(self, snapshot: str) -> None:
        _mark(self.spark, f"{self.folder}/snapshots/{snapshot}")

    def _clean(self, before: list[str], old: set[str]) -> None:
        """Delete the data of batches that the snapshot before the newest holds, and older snapshots, markers first."""
        for batch in sorted(old):
            names = _names(self.spark, self._batch(batch))
            if names != ["_SUCCESS"]:
                if "_SUCCESS" not in names:
                    _mark(self.spark, f"{self._batch(batch)}/_SUCCESS")
                for name in names:
                    if name != "_SUCCESS":
                        remove_path(self.spark, f"{self._batch(batch)}/{name}")
        for snapshot in before[:-1]:
            remove_path(self.spark, f"{self.folder}/snapshots/{snapshot}")
        kept = set(self.snapshots())
        for snapshot in _names(self.spark, f"{self.folder}/rolled"):
            if snapshot not in kept:
                remove_path(self.spark, f"{self.folder}/rolled/{snapshot}")


def word_tokens(text: str = "text"):
    """Tokenizer version ``words-1``: runs without white space."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def piece_tokens(text: str = "text"):
    """Tokenizer version ``pieces-2``: runs of letters, single digits, runs of other signs."""
    pattern = r"\p{L}+|\p{N}|[^\x20\x09-\x0D\p{L}\p{N}]+"
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(pattern)).cast("long")

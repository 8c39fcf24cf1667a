"""A corpus pipeline: toxic documents go, near-duplicates go, benchmark leaks go, secrets are masked, texts are encoded.

Each stage takes the documents its predecessor kept, as written, and decides on those alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import bpe, decontamination, secrets, simhash, toxicity
from cadastra.llm.common import prepare, read_table
from cadastra.llm.queries import tokenizer_path
from cadastra.shared import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# No DuckDB SQL can learn the classifier or run the tokenizer; the tests hold run() against a plain version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold. Empty and null texts score the prior and stay."""
    prepare(spark)
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.with_score(docs, model, name="__score")
    return scored.where(F.col("__score") < toxicity.THRESHOLD).drop("__score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the smallest doc_id.

    Where several rows have that id, or a group has no id at all, the first in the order of all their
    columns stays, so exactly one row of each group is kept.
    """
    prepare(spark)
    return simhash.one_of_each(docs, radius=4, shingle=4)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage like a benchmark item."""
    return decontamination.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced in the text, n_chars counted anew where one was."""
    prepare(spark)
    return secrets.mask_secrets(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left."""
    prepare(spark)
    return bpe.digest_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scan", mask_secrets),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

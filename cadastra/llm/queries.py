"""One query per operator over its whole table, with production parameters, and the SQL of those SQL can say."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import (
    alignment, bpe, byte_bpe, decontamination, quality, secrets, sharding, simhash, spelling, substring, suffix,
    token_counts, toxicity,
)
from cadastra.llm.common import read_table
from cadastra.shared import scratch_path, stage

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of an installed vocabulary file, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontamination.contaminated(documents, benchmark).drop("bits")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(read_table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan_secrets(read_table(spark, sf_dir, "documents")))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), radius=4, shingle=4)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are inserted, copies of a text deleted, and counts revised without symbol runs.

    The first batch is sent twice, as after a failure; the second sending must add nothing. The first two
    batches are rolled up into a snapshot, and the first is sent once more.
    """
    docs = read_table(spark, sf_dir, "documents")
    cleaned = F.regexp_replace(F.coalesce("text", F.lit("")), r"[#*$%&|]+", " ")
    counted = stage(docs.select(
        "doc_id", "source", "lang", F.coalesce(F.sha2("text", 256), F.lit("")).alias("digest"),
        token_counts.word_tokens().alias("words"), token_counts.piece_tokens().alias("pieces"),
        F.regexp_count(cleaned, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("revised"),
    ), "counts")
    first = counted.groupBy("digest").agg(F.min("doc_id").alias("first"))
    marked = stage(counted.join(first, "digest").withColumn("copy", F.col("doc_id") > F.col("first")), "marked")

    def changes(df: DataFrame, *of: tuple[str, str | None, str | None]) -> DataFrame:
        kinds = [F.struct(
            F.lit(version).alias("tokenizer"),
            (F.col(old) if old else F.lit(None).cast("long")).alias("old_tokens"),
            (F.col(new) if new else F.lit(None).cast("long")).alias("new_tokens"),
        ) for version, old, new in of]
        return df.select("source", "lang", F.inline(F.array(*kinds)))

    inserts = changes(marked, ("words-1", None, "words"), ("pieces-2", None, "pieces"))
    deletes = changes(marked.where("copy"), ("words-1", "words", None), ("pieces-2", "pieces", None))
    revised = changes(marked.where("NOT copy AND words <> revised"), ("words-1", "words", "revised"))
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "token-rollup"))
    for batch_id, batch in (("load", inserts), ("copies", deletes)):
        rollup.commit(batch_id, batch)
    rollup.compact()
    for batch_id, batch in (("load", inserts), ("revise", revised)):
        rollup.commit(batch_id, batch)
    return rollup.totals()


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), shards=40)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply_rules(read_table(spark, sf_dir, "documents")).drop("rejected_by")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digests(read_table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digest_documents(read_table(spark, sf_dir, "documents"), ranks)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return alignment.digests(read_table(spark, sf_dir, "documents"), a, b)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_bpe": op2_bpe,
    "op3_toxicity": op3_toxicity,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_sharding": op8_sharding,
    "op9_quality_rules": op9_quality_rules,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_spelling_variants": op13_spelling_variants,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {
    "op1_benchmark_decontamination": rf"""
        WITH items AS (
            SELECT item_id, {_WORDS.replace('text', 'lower(text)')} AS words FROM benchmark
        ), item_shingles AS (
            SELECT item_id, len(words) - 4 AS size, words[pos:pos + 4] AS shingle, count(*) AS weight
            FROM (SELECT *, unnest(range(1, len(words) - 3)) AS pos FROM items) GROUP BY ALL
        ), split AS (
            SELECT doc_id, {_WORDS.replace('text', 'lower(text)')} AS words FROM documents
        ), shingles AS (
            SELECT doc_id, len(words) - 4 AS total, pos - 1 AS pos, words[pos:pos + 4] AS shingle
            FROM (SELECT *, unnest(range(1, len(words) - 3)) AS pos FROM split)
        ), windows AS (
            SELECT DISTINCT doc_id, item_id, size, pos AS first_word, least(size, total - pos) AS inside
            FROM shingles JOIN item_shingles USING (shingle)
        ), counted AS (
            SELECT w.doc_id, item_id, size, first_word, inside, shingle, count(*) AS own
            FROM windows w JOIN shingles s
            ON s.doc_id = w.doc_id AND s.pos >= first_word AND s.pos < first_word + size GROUP BY ALL
        ), shared AS (
            SELECT doc_id, item_id, c.size, first_word, inside, sum(least(own, weight))::BIGINT AS common
            FROM counted c JOIN item_shingles USING (item_id, shingle) GROUP BY ALL
        ), scored AS (
            SELECT doc_id, item_id, first_word, common / (inside + size - common) AS similarity
            FROM shared WHERE 10 * common >= 8 * (inside + size - common)
        )
        SELECT doc_id, item_id, max(similarity) AS similarity,
            arg_max(first_word, (similarity, -first_word))::INTEGER AS first_word
        FROM scored GROUP BY doc_id, item_id
    """,
    "op4_substring_dedup": rf"""
        WITH split AS (SELECT doc_id, {_WORDS} AS words FROM documents),
        windows AS (
            SELECT doc_id, pos, array_to_string(words[pos:pos + 19], ' ') AS part
            FROM (SELECT *, unnest(range(1, len(words) - 18)) AS pos FROM split)
        ), judged AS (
            SELECT doc_id, pos, row_number() OVER (PARTITION BY part ORDER BY doc_id, pos) > 1 AS again FROM windows
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM judged WHERE again
        ), listed AS (
            SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM split
        ), kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text
            FROM listed ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
            sha256(coalesce(text, '')) AS kept_sha256
        FROM split LEFT JOIN kept USING (doc_id)
    """,
    "op7_token_counts": r"""
        WITH counted AS (
            SELECT source, lang,
                len(regexp_extract_all(regexp_replace(coalesce(text, ''), '[#*$%&|]+', ' ', 'g'),
                                       '[^\x20\x09-\x0D]+')) AS words,
                len(regexp_extract_all(coalesce(text, ''),
                                       '\p{L}+|\p{N}|[^\x20\x09-\x0D\p{L}\p{N}]+')) AS pieces,
                doc_id > min(doc_id) OVER (PARTITION BY text) AS copy
            FROM documents
        ), kept AS (SELECT * FROM counted WHERE NOT copy)
        SELECT source, lang, 'words-1' AS tokenizer, count(*) AS n_docs, sum(words)::BIGINT AS n_tokens
        FROM kept GROUP BY source, lang
        UNION ALL
        SELECT source, lang, 'pieces-2', count(*), sum(pieces)::BIGINT FROM kept GROUP BY source, lang
    """,
    "op9_quality_rules": rf"""
        WITH split AS (
            SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words,
                row_number() OVER () AS row_id
            FROM documents
        ), windows AS (
            SELECT row_id, pos, words[pos:pos + 2] AS three
            FROM (SELECT row_id, words, unnest(range(1, len(words) - 1)) AS pos FROM split)
        ), found AS (
            SELECT row_id, pos, count(*) OVER (PARTITION BY row_id, three) AS n FROM windows
        ), covered AS (
            SELECT row_id, count(DISTINCT word_at) AS n_repeat_words
            FROM (SELECT row_id, unnest([pos, pos + 1, pos + 2]) AS word_at FROM found WHERE n > 1)
            GROUP BY row_id
        ), measured AS (
            SELECT doc_id, text, len(words)::BIGINT AS n_words,
                coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
                (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                (len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
                 - len(list_distinct(list_filter(string_split(text, chr(10)),
                                                 lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
                coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
            FROM split LEFT JOIN covered USING (row_id)
        ), judged AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                10 * n_symbols > n_words OR 2 * word_chars < 5 * n_words OR word_chars > 15 * n_words
                OR 2 * n_dup_lines > len(string_split(text, chr(10)))
                OR 10 * len(regexp_extract_all(text, '\p{{Lu}}')) > 3 * word_chars
                OR 2 * (length(text) - length(replace(text, '!', ''))) > n_words AS rejected
            FROM measured
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND NOT rejected AS kept
        FROM judged
    """,
}

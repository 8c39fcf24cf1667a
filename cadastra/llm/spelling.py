"""Spelling variants: words at one edit from one another, by asymmetric chunks of two halves.

1. Words are counted over the corpus; from here on only distinct words move.
2. One word, the shorter of a pair, contributes two disjoint chunks, its halves: one edit preserves one of them.
   The half that holds the edit is parted in two again, of which one is preserved too, and so on to
   ``LEVELS`` levels or two code points. So a word has one key per smallest part: all its chunks around that part,
   with their places.
3. The other word, as long or one longer, contributes its grams at the places where these chunks can lie: at the
   same place before the edit, within a shift of one behind it. Keys are joined, and candidates verified
   by their edit distance. Words up to 32 code points agree on all but two of them before they meet, so a chunk
   that many words share makes no crowd.
4. A word's form is the most frequent near word that is frequent enough; roots follow forms by doubling.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.shared import stage

LEAST_LENGTH = 7
LEAST_COUNT = 2
# A form occurs at least this many times as often as its variant.
FORM_FACTOR = 10
LEVELS = 4
# One run in so many loses a code point, chosen by a checksum of the document and the run.
TYPO_EVERY = 31
# Distinct words counted in a task before they are sent on.
HELD_WORDS = 200_000
_RUNS = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}


def _words(text: str, doc_id: str, typo_every: int) -> Iterator[tuple[str, int]]:
    """Each distinct word of a text with its occurrences; letters A to Z in lower case."""
    runs: Counter = Counter()
    for run, n in Counter(_RUNS.findall(text)).items():
        runs[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in runs.items():
        check = zlib.crc32(run.encode(), start)
        if check % typo_every == 0:
            at = check % len(run)
            run = run[:at] + run[at + 1:]
        yield run, n


def word_counts(docs: DataFrame, text: str = "text", typo_every: int = TYPO_EVERY, least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of all whole texts that are long and frequent enough.

    A run loses the code point at (checksum modulo its length) if ``typo_every`` divides the CRC-32 of its document's
    id, a colon and the run. A null text has no words; a null id counts as an empty one. Repeated rows count
    again. Other columns are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for value, doc_id in zip(batch.column(0), batch.column(1)):
                for word, n in _words(value.as_py() or "", doc_id.as_py() or "", typo_every):
                    if len(word) >= least_length:
                        held[word] += n
            if len(held) >= HELD_WORDS:
                yield sent()
                held.clear()
        yield sent()

    listed = docs.select(text, F.col("doc_id").cast("string").alias("id")).mapInArrow(count, "word string, n long")
    return listed.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _parts(length: str, levels: int) -> Column:
    """(lo, hi) of the parts that may hold the edit, by halving a word of this length ``levels`` times."""
    parts = F.expr(f"array(struct(0 AS lo, {length} AS hi))")
    for _ in range(levels):
        parts = F.flatten(F.transform(parts, lambda part: F.when(
            part["hi"] - part["lo"] > 2,
            F.array(*[F.struct(lo.alias("lo"), hi.alias("hi")) for lo, hi in (
                (part["lo"], _middle(part)), (_middle(part), part["hi"]))]),
        ).otherwise(F.array(F.struct(part["lo"].alias("lo"), part["hi"].alias("hi"))))))
    return parts


def _middle(part: Column) -> Column:
    return F.floor((part["lo"] + part["hi"]) / 2).cast("int")


def _keyed(words: DataFrame, shift: int, levels: int) -> DataFrame:
    """(key, word, n): one key per part of a word ``shift`` code points shorter than this one.

    A key is the hash of that length, the part's place, and what lies before the part and, shifted, behind it.
    """
    sized = words.withColumn("size", F.char_length("word") - shift).withColumn("parts", _parts("size", levels))
    part = sized.select("word", "n", "size", F.explode("parts").alias("part"))
    before = F.expr("substring(word, 1, part.lo)")
    behind = F.expr(f"substring(word, part.hi + {1 + shift})")
    return part.select(F.xxhash64("size", "part.lo", before, behind).alias("key"), "word", "n")


def near_words(words: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(left, right, left_n, right_n): each pair of words at exactly one edit, once.

    ``words`` holds distinct words and their counts. The left word is the shorter, or the smaller of two as long.
    """
    chunks = _keyed(words, 0, levels).select("key", F.col("word").alias("left"), F.col("n").alias("left_n"))
    same, longer = (
        _keyed(words, shift, levels).select("key", F.col("word").alias("right"), F.col("n").alias("right_n"))
        for shift in (0, 1)
    )
    found = chunks.join(same, "key").where("left < right").unionAll(chunks.join(longer, "key"))
    verified = found.where(F.levenshtein("left", "right", 1) == 1)
    return verified.select("left", "right", "left_n", "right_n").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: the last that its forms lead to.

    Counts grow along a chain by the factor, so it has few links, and each round doubles those it has covered.
    """
    reached = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = stage(reached.join(ahead, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return reached
        reached = moved.drop("moved")


def variants(words: DataFrame, factor: int = FORM_FACTOR, levels: int = LEVELS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every given word.

    ``form`` is the near word of largest count, the smallest in code-point order of equals, if its count is at least
    ``factor`` times the word's; null without one. ``root`` is the word itself without a form.
    """
    pairs = stage(near_words(words, levels), "near")
    both = pairs.select(F.col("left").alias("word"), F.col("right").alias("near"), F.col("right_n").alias("near_n")).unionAll(
        pairs.select(F.col("right").alias("word"), F.col("left").alias("near"), F.col("left_n").alias("near_n")))
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("least"), "near")).alias("best"))
    frequent = -F.col("best.least") >= factor * F.col("n")
    judged = stage(words.join(best, "word", "left").select(
        "word", F.when(frequent, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, -F.col("best.least")).alias("form_n"),
    ), "forms")
    roots = _roots(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_variants(docs: DataFrame, text: str = "text") -> DataFrame:
    """The variants among the words of all whole texts; see :func:`word_counts` and :func:`variants`.

    No documents, or none with two such words, give no rows.
    """
    return variants(stage(word_counts(docs, text), "words"))

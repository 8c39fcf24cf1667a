"""Toxicity by weak supervision.

Indicators (words and word beginnings) that lean towards toxic documents are mined from labelled rows.
Groups of them become voters: lexicon and pattern voters that vote toxic or abstain, absence voters that
vote clean, and the annotator, whose labels are a vote like any other. A generative label model
estimates by expectation maximization how each voter votes given the hidden class, and discounts voters
for what they share beyond the class, their excess correlation. Its posterior labels train a linear
classifier over the indicators, which scores every whole text; labels, language and source are no inputs.

Training texts are a bounded sample (``MAX_TRAIN`` labelled rows, by hash of doc_id), joined through a
broadcast of their ids. Indicator counts are taken by Spark; the driver holds the sketches, votes and indicators
of the sample, bounded by ``MAX_TRAIN`` and ``MAX_INDICATORS``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.llm.common import let, words_of
from cadastra.shared import stage

MAX_TRAIN = 20_000
MAX_INDICATORS = 4_000
# An indicator is kept if it is in so many toxic training texts at least.
LEAST_TEXTS = 3
# Its log odds, and twice the log likelihood ratio against no lean: 25 is one chance in two million.
LEAST_ODDS = 1.5
LEAST_EVIDENCE = 25.0
# Shares of equal shingle minima from which two training texts are near copies, and how they are looked up.
ALIKE = 0.8
MINIMA = 64
BAND = 4
LEXICON_VOTERS = 16
PATTERN_VOTERS = 8
ABSENCE_VOTERS = 4
THRESHOLD = 0.3
HELD_OUT = 2

_LETTERS = re.compile(r"[^\W\d_]+")
_BEGINNINGS = (4, 5, 6, 7, 8)
_COUNTED = (5, 6, 7)
_REMEMBERED = 200_000


def remainder(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 4; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4))


def indicators_of(word: str) -> list[str]:
    """A word itself and its beginnings, marked by a trailing star."""
    return [word, *(word[:size] + "*" for size in _BEGINNINGS if len(word) >= size)]


def repeated_of(word: str) -> list[str]:
    """The beginnings of a word that are counted: several words with one are indicators of their own."""
    return [word[:size] for size in _COUNTED if len(word) >= size]


def indicators(text: str | None) -> set[str]:
    """All indicators of a text, lower-cased: words, beginnings, and beginnings of two or three words."""
    words = set(_LETTERS.findall((text or "").lower()))
    found = {mark for word in words for mark in indicators_of(word)}
    for start, n in Counter(start for word in words for start in repeated_of(word)).items():
        if n > 1:
            found.add(start + "**")
        if n > 2:
            found.add(start + "***")
    return found


def training_texts(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> DataFrame:
    """(text, toxic) of at most ``most`` labelled rows outside the held-out remainder.

    A document with several labels is toxic if one of them says so; null labels and ids are left out.
    The documents are not shuffled: the sample of ids is bounded and broadcast. Of copies and near copies,
    by :func:`alike`, one stays, so that the words of a text that was copied a hundred times are no evidence;
    it is toxic if at least half of their labels say so. A passage in common merges no texts by itself.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id IS NOT NULL AND toxic IS NOT NULL"
    ).where(remainder(F.col("doc_id")) != HELD_OUT)
    sample = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(
        F.xxhash64("doc_id"), "doc_id"
    ).limit(most)
    given = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic")

    def shingled(words: Column) -> Column:
        windows = F.greatest(F.size(words) - 4, F.lit(0))
        hashes = F.transform(
            F.slice(words, F.lit(1), windows),
            lambda word, at: F.xxhash64(word, words[at + 1], words[at + 2], words[at + 3], words[at + 4]))
        return F.when(F.size(words) > 4, hashes).otherwise(F.array(F.xxhash64(words)))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [minima(row.values.to_numpy().view(np.uint64)) for row in batch.column("hashes")]
            yield pa.RecordBatch.from_pydict({
                "digest": batch.column("digest"), "n": batch.column("n"), "toxic": batch.column("toxic"),
                "minima": pa.array([row.tobytes() for row in found], pa.binary()),
            })

    equal = stage(
        given.groupBy(F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")).agg(
            F.min("text").alias("text"), F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")
        ), "equal",
    )
    table = equal.select(
        "digest", "n", "toxic", let(words_of(F.lower("text")), shingled).alias("hashes")
    ).mapInArrow(sketch, "digest string, n long, toxic long, minima binary").toArrow().sort_by("digest")
    digests = table.column("digest").to_pylist()
    first = alike(np.frombuffer(b"".join(table.column("minima").to_pylist()), np.uint64).reshape(-1, MINIMA))
    rows, toxic = (np.bincount(first, table.column(name).to_numpy(), len(digests)) for name in ("n", "toxic"))
    kept = [(digests[at], int(2 * toxic[at] >= rows[at])) for at in np.unique(first)]
    kept = docs.sparkSession.createDataFrame(kept, "digest string, toxic int")
    return equal.select("digest", "text").join(kept, "digest").select("text", "toxic")


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least of the hashes under each of ``MINIMA`` orders."""
    orders = np.random.default_rng(17).integers(0, 1 << 63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(MINIMA, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 1024):
        mixed = hashes[at:at + 1024, None] * orders
        mixed ^= mixed >> np.uint64(32)
        np.minimum(least, (mixed * np.uint64(0x9E3779B97F4A7C15)).min(0), out=least)
    return least


def alike(sketches: np.ndarray) -> np.ndarray:
    """Per row the first row of its group: rows that agree on ``ALIKE`` of their minima, and chains of such.

    Rows are compared if all minima of one band are equal; at a similarity of 0.8 that misses one pair in 4,000.
    """
    parent = np.arange(len(sketches))

    def root(at: int) -> int:
        while parent[at] != at:
            parent[at] = parent[parent[at]]
            at = parent[at]
        return at

    for band in range(0, MINIMA, BAND):
        keys = np.ascontiguousarray(sketches[:, band:band + BAND]).view(f"V{8 * BAND}").ravel()
        order = np.argsort(keys, kind="stable")
        ends = np.flatnonzero(np.append(keys[order][1:] != keys[order][:-1], True)) + 1
        for members in np.split(order, ends[:-1]) if len(order) else []:
            while len(members) > 1:
                same = (sketches[members] == sketches[members[0]]).mean(1) >= ALIKE
                for at in members[same][1:]:
                    low, high = sorted((root(members[0]), root(at)))
                    parent[high] = low
                members = members[~same]
    return np.array([root(at) for at in range(len(sketches))], np.int64)


def mined(texts: DataFrame, toxic_texts: int, clean_texts: int, most: int = MAX_INDICATORS) -> list[tuple[str, float]]:
    """(indicator, log odds) of those that lean towards toxic texts, strongest first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A few texts at a time: one text has thousands of indicators, most of which occur nowhere else.
        for batch in (b.slice(at, 16) for b in batches for at in range(0, b.num_rows, 16)):
            toxic, clean = Counter(), Counter()
            for text, label in zip(batch.column(0), batch.column(1)):
                (toxic if label.as_py() else clean).update(indicators(text.as_py()))
            marks = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_pydict({
                "mark": pa.array(marks, pa.string()),
                "toxic": pa.array([toxic[m] for m in marks], pa.int64()),
                "clean": pa.array([clean[m] for m in marks], pa.int64()),
            })

    counted = texts.select("text", "toxic").mapInArrow(count, "mark string, toxic long, clean long")
    summed = counted.groupBy("mark").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic_texts + 1)) - F.log((F.col("clean") + 0.5) / (clean_texts + 1))
    share, both = toxic_texts / (toxic_texts + clean_texts), F.col("toxic") + F.col("clean")

    def part(seen: Column, usual: float) -> Column:
        return F.when(seen > 0, seen * F.log(seen / (both * usual))).otherwise(0.0)

    evidence = 2 * (part(F.col("toxic"), share) + part(F.col("clean"), 1 - share))
    sure = summed.where(F.col("toxic") >= LEAST_TEXTS).withColumns({"odds": odds, "evidence": evidence})
    leaning = sure.where((F.col("odds") > LEAST_ODDS) & (F.col("evidence") > LEAST_EVIDENCE))
    best = leaning.orderBy(F.desc("evidence"), "mark").limit(most)
    return [(row["mark"], row["odds"]) for row in best.collect()]


def present(texts: DataFrame, marks: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Places of the indicators in each training text, and the labels, on the driver."""
    place = {mark: at for at, mark in enumerate(marks)}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(place[m] for m in indicators(t.as_py()) if m in place) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), batch.column(1)], ["found", "toxic"]
            )

    table = texts.select("text", "toxic").mapInArrow(find, "found array<int>, toxic int").toArrow()
    found = [np.array(row, np.int64) for row in table.column("found").to_pylist()]
    return found, np.array(table.column("toxic").to_pylist(), np.int64)


def votes(found: list[np.ndarray], labels: np.ndarray, marks: list[str]) -> np.ndarray:
    """Votes of all voters on all texts: 1 toxic, -1 clean, 0 abstains. The annotator is the last."""
    words = [at for at, mark in enumerate(marks) if not mark.endswith("*")]
    beginnings = [at for at, mark in enumerate(marks) if mark.endswith("*")]
    groups = [set(words[k::LEXICON_VOTERS]) for k in range(LEXICON_VOTERS)]
    groups += [set(beginnings[k::PATTERN_VOTERS]) for k in range(PATTERN_VOTERS)]
    absences = [set(range(k, len(marks), ABSENCE_VOTERS)) for k in range(ABSENCE_VOTERS)]
    cast = np.zeros((len(found), len(groups) + len(absences) + 1), np.int8)
    for row, places in enumerate(found):
        here = set(places.tolist())
        for voter, group in enumerate(groups):
            cast[row, voter] = not here.isdisjoint(group)
        for voter, group in enumerate(absences, len(groups)):
            cast[row, voter] = -here.isdisjoint(group)
    cast[:, -1] = np.where(labels > 0, 1, -1)
    return cast


@dataclass
class LabelModel:
    """Vote probabilities per voter and class, class prior, and discounts for shared evidence."""

    prior: float
    chances: np.ndarray  # voter, class, vote + 1
    discount: np.ndarray

    def posterior(self, cast: np.ndarray) -> np.ndarray:
        """Probability that each text is toxic."""
        log_odds = np.full(len(cast), math.log(self.prior / (1 - self.prior)))
        for voter in range(cast.shape[1]):
            vote = cast[:, voter].astype(np.int64) + 1
            ratio = np.log(self.chances[voter, 1]) - np.log(self.chances[voter, 0])
            log_odds += self.discount[voter] * ratio[vote]
        return 1 / (1 + np.exp(-np.clip(log_odds, -50, 50)))


def fit_label_model(cast: np.ndarray, rounds: int = 30) -> LabelModel:
    """Accuracies by expectation maximization, and correlations from what the classes leave over.

    The first posterior is the last voter's, the annotator. Votes of two voters, less their mean given
    the class, correlate if they share more than the class; a voter's evidence counts divided by one
    plus the sum of its positive excess correlations with the others of its kind.
    """
    size, voters = cast.shape
    belief = np.where(cast[:, -1] > 0, 0.9, 0.05)
    model = LabelModel(0.1, np.full((voters, 2, 3), 1 / 3), np.ones(voters))
    for _ in range(rounds):
        weights = np.stack([1 - belief, belief])
        model.prior = float(np.clip(belief.mean(), 1e-4, 1 - 1e-4))
        left = cast.astype(np.float64)
        for voter in range(voters):
            for k in (0, 1):
                counts = np.bincount(cast[:, voter].astype(np.int64) + 1, weights[k], 3) + 0.5
                model.chances[voter, k] = counts / counts.sum()
            means = model.chances[voter] @ np.array([-1.0, 0.0, 1.0])
            left[:, voter] -= weights[0] * means[0] + weights[1] * means[1]
        spread = np.sqrt((left ** 2).mean(0)) + 1e-9
        excess = (left.T @ left) / size / np.outer(spread, spread)
        np.fill_diagonal(excess, 0)
        model.discount = 1 / (1 + np.clip(excess, 0, 1).sum(1))
        model.discount[-1] = 1.0
        now = model.posterior(cast)
        if np.abs(now - belief).max() < 1e-4:
            break
        belief = now
    return model


def fit_linear(found: list[np.ndarray], belief: np.ndarray, kinds: int, rounds: int = 1_500) -> tuple[np.ndarray, float]:
    """Weights and bias of logistic regression on presence of indicators, by adaptive gradients."""
    rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
    places = np.concatenate(found) if len(rows) else np.zeros(0, np.int64)
    weight, bias = np.zeros(kinds), -2.0
    moved, moved_bias = np.full(kinds, 1e-6), 1e-6
    shrink = 1e-6
    for _ in range(rounds):
        z = bias + np.bincount(rows, weight[places], len(found))
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - belief
        slope = np.bincount(places, error[rows], kinds) / max(len(found), 1) + shrink * weight
        moved += slope ** 2
        weight -= 0.3 * slope / np.sqrt(moved)
        tilt = error.mean()
        moved_bias += tilt ** 2
        bias -= 0.3 * tilt / math.sqrt(moved_bias)
    return weight, bias


@dataclass
class ToxicityModel:
    """Weights of indicators and the bias; a text's score is the logistic of their sum."""

    weights: dict[str, float]
    bias: float

    def scorer(self):
        weights, bias, known = self.weights, self.bias, {}
        counted = {mark.rstrip("*") for mark in weights if mark.endswith("**")}

        def score(text: str | None) -> float:
            found, starts = set(), []
            for word in set(_LETTERS.findall((text or "").lower())):
                marks = known.get(word)
                if marks is None:
                    marks = (tuple(m for m in indicators_of(word) if m in weights),
                             tuple(s for s in repeated_of(word) if s in counted))
                    if len(known) >= _REMEMBERED:
                        known.clear()
                    if len(word) < 64:
                        known[word] = marks
                found.update(marks[0])
                starts += marks[1]
            for start, n in Counter(starts).items():
                several = [start + "**"] * (n > 1) + [start + "***"] * (n > 2)
                found.update(mark for mark in several if mark in weights)
            total = bias + sum(weights[m] for m in sorted(found))
            return 1 / (1 + math.exp(-max(-50.0, min(50.0, total))))

        return score


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> ToxicityModel:
    """Mine indicators, estimate the label model, and train the classifier on its posteriors.

    With no indicator found, as without labelled rows of either kind, every text scores the prior, or half
    the threshold if that is less: nothing tells the texts apart, so none is called toxic.
    """
    texts = stage(training_texts(docs, labels, most), "training")
    toxic, rows = texts.agg(F.count_if(F.col("toxic") > 0), F.count(F.lit(1))).first()
    prior = min((toxic + 0.5) / (rows + 10), THRESHOLD / 2)
    empty = ToxicityModel({}, math.log(prior / (1 - prior)))
    if not toxic or toxic == rows:
        return empty
    marks = [mark for mark, _ in mined(texts, toxic, rows - toxic)]
    if not marks:
        return empty
    found, given = present(texts, marks)
    cast = votes(found, given, marks)
    belief = fit_label_model(cast).posterior(cast)
    weight, bias = fit_linear(found, belief, len(marks))
    return ToxicityModel(dict(zip(marks, weight.tolist())), float(bias))


def with_score(docs: DataFrame, model: ToxicityModel, text: str = "text", name: str = "toxicity") -> DataFrame:
    """The rows of ``docs`` with the score of their whole text as a last column; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            scores = pa.array([score(value.as_py()) for value in batch.column(text)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def score_documents(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted. Other columns are not read."""
    model = fit(docs, labels, most)
    scored = with_score(docs.select("doc_id", "text"), model, name="score")
    return scored.select(
        "doc_id", (remainder(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

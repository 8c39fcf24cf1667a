"""Quality rules as a short-circuit cascade.

Each rule rejects some documents at some cost. Both are estimated in one aggregate over a sample: rejections are
counted, and the sample's code points, words and lines give the cost of the steps a rule takes from the raw text.
The rules are ordered by rejection per cost, and one CASE expression tests them in that order, so a rule runs only
on rows that all before it let pass. The order is the same in repeated runs. :func:`verdicts` skips the measures of rules it
does not reach; :func:`apply_rules` also returns the measures, and so computes all of them for every row.
The order decides cost alone; a document is kept when no rule rejects it. Column expressions only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import let, words_of

MIN_WORDS = 50
# Rows on which cost and selectivity are estimated. They steer the order of the rules, nothing else.
SAMPLE_ROWS = 2_000
# Nanoseconds of each step per code point, word and line, as measured over the given documents on one core.
STEPS = {
    "words": (50, 0, 0), "word_chars": (0, 300, 0), "windows": (0, 1_800, 0),
    "symbols": (12, 0, 0), "lines": (3, 0, 1_000), "scan": (10, 0, 0),
}
_ROW = 100
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A name and the condition on which a document is rejected, over the text and the measures.

    ``raw`` is the same condition over the text alone; without it the measures are computed first.
    ``steps`` are what the condition takes from the raw text, of :data:`STEPS`, each counted once.
    """

    name: str
    rejects: Column
    raw: Column | None = None
    steps: tuple[str, ...] = ("scan",)


def _repeated_words(words: Column) -> Column:
    """Words covered by three-word windows that occur at least twice. ``words`` is a bound variable."""
    windows = F.greatest(F.size(words) - 2, F.lit(0))
    hashes = F.transform(
        F.slice(words, F.lit(1), windows), lambda word, at: F.xxhash64(word, words[at + 1], words[at + 2])
    )

    def covered(placed: Column) -> Column:
        starts = F.flatten(F.transform(
            F.slice(placed, F.lit(2), windows),
            lambda this, at: F.when(
                this["h"] == placed[at]["h"], F.array(placed[at]["at"], this["at"])
            ).otherwise(F.array().cast("array<int>")),
        ))
        around = F.transform(F.array_distinct(starts), lambda at: F.array(at, at + 1, at + 2))
        return F.size(F.array_distinct(F.flatten(around)))

    def count(hashed: Column) -> Column:
        placed = F.transform(hashed, lambda h, at: F.struct(h.alias("h"), at.alias("at")))
        return F.when(F.size(F.array_distinct(hashed)) == F.size(hashed), F.lit(0)).otherwise(
            let(F.sort_array(placed), covered)
        )

    return let(hashes, count)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the five measures of their text, all longs.

    A null text has no words. Columns of these names already in ``docs`` are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    of_words = let(words_of(F.col(text)), lambda words: F.struct(
        F.size(words).alias("n_words"),
        F.aggregate(words, F.lit(0), lambda total, word: total + F.length(word)).alias("word_chars"),
        _repeated_words(words).alias("n_repeat_words"),
    ))
    return docs.withColumn("_of_words", of_words).withColumns({
        "n_words": F.col("_of_words.n_words").cast("long"),
        "word_chars": F.col("_of_words.word_chars").cast("long"),
        "n_repeat_words": F.col("_of_words.n_repeat_words").cast("long"),
        "n_symbols": (F.size(F.split(whole, r"[#*$%&|<>]")) - 1).cast("long"),
        "n_dup_lines": let(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept))).cast("long"),
    }).drop("_of_words")


def measure(name: str, text: str = "text") -> Column:
    """One of the five measures from the text alone, as :func:`measured` gives it."""
    whole, words = F.coalesce(F.col(text), F.lit("")), words_of(F.col(text))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    of = {
        "n_words": lambda: F.size(words),
        "word_chars": lambda: F.aggregate(words, F.lit(0), lambda total, word: total + F.length(word)),
        "n_repeat_words": lambda: let(words, _repeated_words),
        "n_symbols": lambda: F.size(F.split(whole, r"[#*$%&|<>]")) - 1,
        "n_dup_lines": lambda: let(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept))),
    }
    return of[name]().cast("long")


_STEPS_OF = {
    "n_words": ("words",), "word_chars": ("words", "word_chars"), "n_repeat_words": ("words", "windows"),
    "n_symbols": ("symbols",), "n_dup_lines": ("lines",),
}


def _rule(
    name: str, condition: Callable[[Callable[[str], Column]], Column], text: str, also: tuple[str, ...] = ()
) -> Rule:
    """A rule over the measures; its steps are those of the measures it asks for, and ``also``."""
    steps = list(also)

    def raw(of: str) -> Column:
        steps.extend(_STEPS_OF[of])
        return measure(of, text)

    over_text = condition(raw)
    return Rule(name, condition(F.col), over_text, tuple(dict.fromkeys(steps)))


def base_rules(text: str = "text") -> list[Rule]:
    """Too short, or most words in repeated windows."""
    return [
        _rule("few_words", lambda of: of("n_words") < MIN_WORDS, text),
        _rule("repeated_words", lambda of: 100 * of("n_repeat_words") > 50 * of("n_words"), text),
    ]


def prose_rules(text: str = "text") -> list[Rule]:
    """What ordinary prose of any language in the tables stays far away from."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return [
        _rule("symbols", lambda of: 10 * of("n_symbols") > of("n_words"), text),
        _rule("word_length", lambda of: (2 * of("word_chars") < 5 * of("n_words"))
              | (of("word_chars") > 15 * of("n_words")), text),
        _rule("repeated_lines", lambda of: 2 * of("n_dup_lines") > F.size(F.split(whole, "\n")), text),
        _rule("shouting", lambda of: 10 * F.regexp_count(whole, F.lit(r"\p{Lu}")) > 3 * of("word_chars"), text, ("scan",)),
        _rule("exclaiming", lambda of: 2 * F.regexp_count(whole, F.lit("!")) > of("n_words"), text, ("scan",)),
    ]


def ordered_by_yield(
    docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS, text: str = "text"
) -> list[Rule]:
    """Rules by rejections per cost on a sample, highest first; the cheaper, then the smaller name break ties.

    One aggregate over the sample counts what every rule rejects and the code points, words and lines.
    """
    share = min(1.0, 1.2 * sample_rows / max(docs.count(), 1))
    sample = docs.sample(share, 11).select(text)
    whole = F.coalesce(F.col(text), F.lit(""))
    sizes = (F.length(whole), F.size(words_of(F.col(text))), F.size(F.split(whole, "\n")))
    if any(rule.raw is None for rule in rules):
        sample = measured(sample, text)
    rejections = [F.count_if(rule.rejects if rule.raw is None else rule.raw) for rule in rules]
    totals = [F.coalesce(F.sum(size), F.lit(0)) for size in sizes]
    rows, *found = sample.agg(F.count(F.lit(1)), *totals, *rejections).first()
    sizes_found, rejected = found[:3], found[3:]

    def cost(rule: Rule) -> int:
        return _ROW * max(rows, 1) + sum(
            each * size for step in rule.steps for each, size in zip(STEPS[step], sizes_found)
        )

    judged = [(-n / cost(rule), cost(rule), rule.name, at) for at, (n, rule) in enumerate(zip(rejected, rules))]
    return [rules[at] for *_, at in sorted(judged)]


def cascade(rules: Sequence[Rule], raw: bool = False) -> Column:
    """The name of the first rule that rejects a row, null when none does; tested in this order."""
    first = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule in rules:
        first = first.when(rule.raw if raw else rule.rejects, F.lit(rule.name))
    return first


def verdicts(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text") -> DataFrame:
    """(doc_id, kept, rejected_by) as by :func:`apply_rules`, measures computed only for the rules reached.

    Rules without a condition over the text alone have the measures of all rows computed.
    """
    read = docs.select("doc_id", text)
    both = [*base_rules(text), *(prose_rules(text) if rules is None else rules)]
    ordered, raw = ordered_by_yield(read, both, text=text), all(rule.raw is not None for rule in both)
    found = (read if raw else measured(read, text)).withColumn("rejected_by", cascade(ordered, raw))
    return found.select("doc_id", F.col("rejected_by").isNull().alias("kept"), "rejected_by")


def apply_rules(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text") -> DataFrame:
    """Per row: doc_id, the measures, base_failed, kept, rejected_by (the rule, null when kept).

    Rows with a null text or id are judged like any other, repeated rows each get a row, and an empty
    table gives an empty result. Columns other than doc_id and the text are not read. ``rejected_by``
    names one of the rules that reject; which one depends on the order the sample gave.
    """
    read = docs.select("doc_id", text)
    found = measured(read, text)
    base = base_rules(text)
    ordered = ordered_by_yield(read, [*base, *(prose_rules(text) if rules is None else rules)], text=text)
    return found.withColumn("rejected_by", cascade(ordered)).select(
        "doc_id", *MEASURES,
        (base[0].rejects | base[1].rejects).alias("base_failed"),
        F.col("rejected_by").isNull().alias("kept"),
        "rejected_by",
    )

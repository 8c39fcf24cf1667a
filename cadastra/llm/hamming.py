"""Multi-index search of fingerprints within a number of bits: which segments, which masks."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 64


def search_plan(radius: int, segments: int, width: int = BITS) -> list[tuple[int, int, int]]:
    """(shift, width, bits) of each segment of ``width`` bits to search: the pigeonhole bound with its remainder.

    If all of the first ``b + 1`` segments differ by more than ``a`` bits and the others by more than
    ``a - 1``, the distance is over ``a * segments + b``, the radius.
    """
    a, b = divmod(radius, segments)
    widths = [width // segments + (at < width % segments) for at in range(segments)]
    shifts = [sum(widths[:at]) for at in range(segments)]
    plan = [(s, w, a if at <= b else a - 1) for at, (s, w) in enumerate(zip(shifts, widths))]
    return [part for part in plan if part[2] >= 0]


def ball(width: int, bits: int) -> list[int]:
    """All masks of at most ``bits`` ones among ``width``."""
    return [sum(1 << i for i in ones) for n in range(bits + 1) for ones in combinations(range(width), n)]


def _value(fingerprint: str, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fingerprint, shift).bitwiseAND((1 << width) - 1)


def entries(df: DataFrame, fingerprint: str, plan: list[tuple[int, int, int]]) -> DataFrame:
    """Each row once per searched segment, with its number and value: columns segment, key first."""
    pairs = [
        F.struct(F.lit(at).alias("segment"), _value(fingerprint, s, w).alias("key"))
        for at, (s, w, _) in enumerate(plan)
    ]
    return df.select(F.inline(F.array(*pairs)), *df.columns)


def rest(value: str, plan: list[tuple[int, int, int]]) -> Column:
    """The bits of an entry's value outside its segment, moved together."""
    found = F.when(F.lit(False), F.lit(None).cast("long"))
    for at, (shift, width, _) in enumerate(plan):
        low = F.col(value).bitwiseAND((1 << shift) - 1)
        high = F.shiftleft(F.shiftrightunsigned(value, shift + width), shift) if shift + width < BITS else F.lit(0)
        found = found.when(F.col("segment") == at, low.bitwiseOR(high))
    return found


def balls(of: DataFrame, plan: list[tuple[int, int, int]]) -> DataFrame:
    """Each entry once for every value in the ball around its key."""
    choice = F.when(F.lit(False), F.lit(None).cast("array<long>"))
    for at, (_, width, bits) in enumerate(plan):
        choice = choice.when(F.col("segment") == at, F.lit(ball(width, bits)).cast("array<long>"))
    rest = [name for name in of.columns if name not in ("segment", "key")]
    spread = of.select("segment", "key", *rest, F.explode(choice).alias("mask"))
    return spread.select("segment", F.col("key").bitwiseXOR(F.col("mask")).alias("key"), *rest)

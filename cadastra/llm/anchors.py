"""Content-chosen anchors of fixed-size windows, and a bounded filter of those that recur.

A window's anchor is the least hash among its grams, the leftmost of equals, so equal windows have equal
anchors at the same place inside. Neighbouring windows mostly share an anchor occurrence; such a run is
a few hundred bits of index for all its windows. A window that recurs has an anchor that recurs, which
spares the rest of the corpus any further work.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MASK64 = (1 << 64) - 1
# Bits of a hash that order grams, above those that hold a gram's place.
_PLACE_BITS = 24
_BLOCK = 1 << 23
# The filter never grows beyond this; fuller, it lets more through and the exact counts drop it later.
MOST_BITS = 1 << 28
_SHIFTS = (0, 19, 37)


@lru_cache(maxsize=16)
def constants(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit multipliers from a counter-based generator."""
    found, state = [], seed
    for _ in range(count):
        state = (state + 0x9E3779B97F4A7C15) & MASK64
        z = (state ^ state >> 30) * 0xBF58476D1CE4E5B9 & MASK64
        z = (z ^ z >> 27) * 0x94D049BB133111EB & MASK64
        found.append((z ^ z >> 31) | 1)
    return np.array(found, np.uint64)


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Hashes with every input bit spread over all bits."""
    hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    hashes = (hashes ^ (hashes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return hashes ^ (hashes >> np.uint64(31))


def gram_hashes(symbols: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash of each run of ``size`` symbols, linear in symbols that are hashes themselves."""
    count = len(symbols) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for at, factor in enumerate(constants(size, seed)):
        total += symbols[at:at + count] * factor
    return mixed(total)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values, by doubling."""
    least, reach = values, 1
    while reach * 2 <= width:
        least, reach = np.minimum(least[:-reach], least[reach:]), reach * 2
    if reach < width:
        least = np.minimum(least[:reach - width], least[width - reach:])
    return least


def runs(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, end, place of the anchor gram) of each run of windows with one anchor occurrence.

    A window is ``width`` grams; window i starts at gram i.
    """
    parts = []
    for base in range(0, max(0, len(grams) - width + 1), _BLOCK):
        part = grams[base:base + _BLOCK + width - 1]
        low = np.uint64((1 << _PLACE_BITS) - 1)
        keys = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        least = sliding_least(keys, width)
        starts = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        ends = np.append(starts[1:], len(least))
        places = (least[starts] & low).astype(np.int64)
        parts.append((starts + base, ends + base, places + base))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(column) for column in zip(*parts))


class Recurring:
    """A Bloom filter of hashes: may hold more than was put in, never less."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(len(words) * 64 - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for shift in _SHIFTS:
            bit = (hashes >> np.uint64(shift)) & self.mask
            found &= (self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) > 0
        return found


def recurring(counts: DataFrame, most_bits: int = MOST_BITS) -> Recurring:
    """The filter of all values of the long column ``anchor`` whose ``n`` sum to two or more.

    Set on the executors; at most ``most_bits / 64`` words come to the driver.
    """
    often = counts.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor").persist()
    try:
        size = 1 << max(16, math.ceil(math.log2(10 * (often.count() + 1))))
        size = min(size, most_bits)
        bits = [F.shiftrightunsigned("anchor", shift).bitwiseAND(size - 1) for shift in _SHIFTS]
        words = often.select(F.explode(F.array(*bits)).alias("bit")).groupBy(
            F.shiftright("bit", 6).alias("word")
        ).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits")).toArrow()
    finally:
        often.unpersist()
    filled = np.zeros(size // 64, np.uint64)
    if words.num_rows:
        filled[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return Recurring(filled)

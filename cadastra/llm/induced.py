"""Suffix sorting with common prefixes by induced sorting on disk.

Suffixes are either smaller (S) or larger (L) than their right neighbour. Sorting the leftmost S suffixes
of each run, by naming the stretches between them and recursing on the names, lets all others be induced:
one pass up the queue derives the L suffixes, one pass down the S suffixes. The queue is a priority queue
with a fixed place for each suffix, by first symbol and arrival; it lies in files, carries the suffix and
its common prefix with the one before, and is popped in stretches none of whose pushes fall inside them,
so each stretch is a handful of array operations. Common prefixes are induced along: one more than the
least among the sources' in between. They are cut at ``cap``.

Types, queues and prefixes larger than ``IN_MEMORY`` symbols live in memory-mapped files. The leftmost S
suffixes, up to half of all, with their names, lengths and common prefixes are arrays in memory.
"""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass

import numpy as np

IN_MEMORY = 1 << 16
_STRETCH = 1 << 18


class Disk:
    """Arrays in files of one folder."""

    def __init__(self, folder: str):
        self.folder, self.made = folder, 0

    def array(self, size: int, kind, fill: int | None = None) -> np.ndarray:
        if size <= IN_MEMORY:
            found = np.empty(size, kind)
        else:
            self.made += 1
            mapped = np.memmap(os.path.join(self.folder, f"{self.made}.bin"), kind, "w+", shape=(size,))
            found = mapped.view(np.ndarray)  # plain views of it cost less to cut
        if fill is not None:
            found[:] = fill
        return found


@dataclass
class Typed:
    """A text of symbols with the types of its suffixes and the bounds of its buckets."""

    text: np.ndarray
    smaller: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @property
    def leftmost(self) -> np.ndarray:
        """S suffixes with an L suffix on their left, in order of the text."""
        found, size = [], len(self.text)
        for base in range(1, size, _STRETCH):
            top = min(size, base + _STRETCH)
            found.append(base + np.flatnonzero(self.smaller[base:top] & ~self.smaller[base - 1:top - 1]))
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def typed(text: np.ndarray, kinds: int, disk: Disk) -> Typed:
    size = len(text)
    smaller = disk.array(size, bool)
    smaller[size - 1] = False  # the end is smaller than any symbol
    after, top = False, size - 1
    while top > 0:
        base = max(0, top - _STRETCH)
        here, right = text[base:top].astype(np.int64), text[base + 1:top + 1].astype(np.int64)
        differs = np.flatnonzero(here != right)
        part = np.empty(top - base, bool)
        # Equal symbols take the type of the next pair that differs.
        upcoming = np.searchsorted(differs, np.arange(top - base))
        inside = upcoming < len(differs)
        part[inside] = (here < right)[differs[upcoming[inside]]]
        part[~inside] = after
        smaller[base:top] = part
        after, top = bool(part[0]), base
    counts = np.zeros(kinds, np.int64)
    for base in range(0, size, _STRETCH):
        counts += np.bincount(text[base:base + _STRETCH], minlength=kinds)
    ends = np.cumsum(counts)
    return Typed(text, smaller, ends - counts, ends)


def common_prefix(text: np.ndarray, left: np.ndarray, right: np.ndarray, cap: int) -> np.ndarray:
    """Equal symbols from each pair of places on, at most ``cap``; over open pairs, bytes eight at a time."""
    found = np.zeros(len(left), np.int32)
    size, open_pairs, step = len(text), np.arange(len(left)), 1
    if text.dtype == np.uint8 and size > 8:
        # The eight bytes from each place on, as one number, the first byte lowest.
        wide, step = np.ndarray((size - 7,), "<u8", np.ascontiguousarray(text), strides=(1,)), 8
        for _ in range(0, cap, step):
            a, b = left[open_pairs] + found[open_pairs], right[open_pairs] + found[open_pairs]
            inside = np.maximum(a, b) < size - 7
            open_pairs, a, b = open_pairs[inside], a[inside], b[inside]
            differs = wide[a] ^ wide[b]
            lowest = differs & (~differs + np.uint64(1))
            found[open_pairs] += np.where(differs == 0, 8, (np.bitwise_count(lowest - np.uint64(1)) >> 3)).astype(np.int32)
            open_pairs = open_pairs[differs == 0]
            if not len(open_pairs):
                break
        open_pairs = np.flatnonzero((found < cap) & (np.maximum(left, right) + found >= size - 7))
    for _ in range(cap):
        a, b = left[open_pairs] + found[open_pairs], right[open_pairs] + found[open_pairs]
        inside = (a < size) & (b < size)
        open_pairs, a, b = open_pairs[inside], a[inside], b[inside]
        open_pairs = open_pairs[text[a] == text[b]]
        if not len(open_pairs):
            break
        found[open_pairs] += 1
    return np.minimum(found, cap)


def _grouped(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by symbol; and, in that order, firsts of groups, group sizes, rank within the group."""
    if not len(symbols):
        return (np.zeros(0, np.int64),) * 4
    # Symbols of 16 bits are sorted by digits instead of by comparison.
    order = np.argsort(symbols.astype(np.uint16) if symbols.max() < 1 << 16 else symbols, kind="stable")
    ordered = symbols[order]
    begins = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=begins[1:])
    firsts = np.flatnonzero(begins)
    sizes = np.empty(len(firsts), np.int64)
    np.subtract(firsts[1:], firsts[:-1], out=sizes[:-1])
    sizes[-1] = len(ordered) - firsts[-1]
    return order, firsts, sizes, np.arange(len(ordered)) - np.repeat(firsts, sizes)


class _Least:
    """Least value of ranges of an array, by a table of powers of two."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 ** len(self.rows) <= len(values):
            half, last = 2 ** (len(self.rows) - 1), self.rows[-1]
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Over first..last, both included."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        found = np.empty(len(first), self.rows[0].dtype)
        for at in np.unique(level):
            here = level == at
            found[here] = np.minimum(self.rows[at][first[here]], self.rows[at][last[here] - 2 ** at + 1])
        return found


def _chained(shared: np.ndarray, sources: np.ndarray, order, firsts, sizes, symbols, running: np.ndarray) -> np.ndarray:
    """Least common prefix since the previous push to the same symbol, per push in group order.

    ``shared`` holds each popped suffix's common prefix with the one popped before; ``sources`` the places
    of the pushes in it. ``running`` has, per symbol, the least since its last push, and is moved on.
    """
    least = _Least(shared)
    at = sources[order]
    found = np.empty(len(at), shared.dtype)
    head = np.zeros(len(at), bool)
    head[firsts] = True
    rest = np.flatnonzero(~head)
    found[rest] = least.of(at[rest - 1] + 1, at[rest])
    kinds = symbols[order[firsts]]
    found[firsts] = np.minimum(running[kinds], np.minimum.accumulate(shared)[at[firsts]])
    np.minimum(running, shared.min(), out=running)
    last = at[firsts + sizes - 1]
    after = np.append(np.minimum.accumulate(shared[::-1])[::-1], np.iinfo(shared.dtype).max)
    running[kinds] = after[last + 1]
    return found


def induce(part: Typed, seeds: np.ndarray, disk: Disk, shared: np.ndarray | None = None, cap: int = 0):
    """All suffixes in order from the leftmost S suffixes ``seeds``; with common prefixes if given theirs.

    ``shared[i]`` is what seeds i - 1 and i have in common. Returns (suffixes, common prefixes or None).
    """
    text, smaller, size = part.text, part.smaller, len(part.text)
    queue = disk.array(size, np.int64, -1)
    prefixes = disk.array(size + 1, np.int32, 0) if shared is not None else None
    order, firsts, sizes, rank = _grouped(text[seeds].astype(np.int64))
    kinds = text[seeds[order[firsts]]].astype(np.int64)
    slots = np.repeat(part.ends[kinds] - sizes, sizes) + rank
    queue[slots] = seeds[order]
    seeded = np.zeros(len(part.ends), np.int64)
    seeded[kinds] = sizes
    if prefixes is not None:
        prefixes[slots] = np.where(rank == 0, 0, shared[order])

    # Up: L suffixes, from the end of the text and from everything popped.
    head = part.starts.copy()
    most = np.iinfo(np.int32).max
    running = np.full(len(head), most, np.int32)
    last = int(text[size - 1])
    queue[head[last]] = size - 1
    head[last] += 1
    running[last] = 0
    low, step, latest = 0, 1024, -1
    while low < size:
        high = min(size, low + step)
        block = np.array(queue[low:high])
        filled = np.flatnonzero(block >= 0)
        before = block[filled] - 1
        pushes = np.flatnonzero((before >= 0) & ~smaller[np.maximum(before, 0)])
        symbols = text[before[pushes]].astype(np.int64)
        # The first push to a symbol takes its head, so the least head is where the stretch has to end.
        lowest = int(head[symbols].min()) if len(symbols) else high
        if lowest < high:
            high = lowest
            keep = np.searchsorted(filled, high - low)
            filled = filled[:keep]
            pushes = pushes[:np.searchsorted(pushes, keep)]
            symbols = symbols[:len(pushes)]
            step = max(256, 2 * (high - low))
        else:
            step = min(_STRETCH, step * 2)
        order, firsts, sizes, rank = _grouped(symbols)
        kinds = symbols[order[firsts]]
        slots = np.repeat(head[kinds], sizes) + rank
        if prefixes is not None and len(filled):
            popped = np.array(prefixes[low:high])[filled]
            # The first seed of a bucket after its L suffixes: what both have in common is compared.
            first_seed = part.ends - seeded
            places = low + filled
            of = text[block[filled]].astype(np.int64)
            seam = np.flatnonzero((places == first_seed[of]) & (seeded[of] > 0) & (head[of] > part.starts[of]))
            if len(seam):
                left = np.array(queue[head[of[seam]] - 1])
                popped[seam] = common_prefix(text, left, block[filled[seam]], cap)
            if len(pushes):
                chained = _chained(popped, pushes, order, firsts, sizes, symbols, running)
                begun = np.repeat(head[kinds] > part.starts[kinds], sizes) | (rank > 0)
                prefixes[slots] = np.where(begun, np.minimum(chained.astype(np.int64) + 1, cap), 0)
            else:
                np.minimum(running, popped.min(), out=running)
        if len(pushes):
            queue[slots] = before[pushes[order]]
            head[kinds] += sizes
        low = high

    # Down: S suffixes, from everything popped, the larger ones first.
    tail = part.ends.copy()
    running = np.full(len(tail), most, np.int32)
    top, step = size, 1024
    while top > 0:
        low = max(0, top - step)
        block = np.array(queue[low:top])[::-1]  # popped from the top
        before = block - 1
        known = before >= 0
        pushes = np.flatnonzero(known & smaller[np.maximum(before, 0)])
        symbols = text[before[pushes]].astype(np.int64)
        # A smaller suffix is pushed from a larger symbol, or from an S suffix of its own.
        highest = int(tail[symbols].max()) if len(symbols) else low
        if highest > low:
            low = highest
            pushes = pushes[:np.searchsorted(pushes, top - low)]
            symbols = symbols[:len(pushes)]
            step = max(256, 2 * (top - low))
        else:
            step = min(_STRETCH, step * 2)
        order, firsts, sizes, rank = _grouped(symbols)
        kinds = symbols[order[firsts]]
        slots = np.repeat(tail[kinds], sizes) - 1 - rank
        block = block[:top - low]
        if prefixes is not None:
            # head is where L suffixes end and S suffixes begin.
            of = text[block].astype(np.int64)
            places = np.arange(top - 1, low - 1, -1)
            seam = np.flatnonzero((places == head[of] - 1) & (head[of] < part.ends[of]))
            if len(seam):
                prefixes[places[seam] + 1] = common_prefix(text, block[seam], np.array(queue[places[seam] + 1]), cap)
            popped = np.array(prefixes[low + 1:top + 1])[::-1]
            edge = places + 1 == part.ends[of]
            popped = np.where(edge, 0, popped).astype(np.int32)
            if len(pushes):
                chained = _chained(popped, pushes, order, firsts, sizes, symbols, running)
                begun = np.repeat(tail[kinds] < part.ends[kinds], sizes) | (rank > 0)
                prefixes[(slots + 1)[begun]] = np.minimum(chained[begun].astype(np.int64) + 1, cap)
            else:
                np.minimum(running, popped.min(), out=running)
        if len(pushes):
            queue[slots] = before[pushes[order]]
            tail[kinds] -= sizes
        top = low
    if prefixes is not None:
        prefixes[part.starts[part.ends > part.starts]] = 0
    return queue, prefixes


def _named(part: Typed, ordered: np.ndarray, leftmost: np.ndarray, disk: Disk) -> tuple[np.ndarray, int]:
    """Names of the stretches between leftmost S suffixes, in order of the text, equal for equal ones."""
    following = np.append(leftmost[1:], len(part.text))
    lengths = following - leftmost + 1  # the next one's first symbol belongs to the stretch
    number = disk.array(len(part.text), np.int32)
    number[leftmost] = np.arange(len(leftmost), dtype=np.int32)
    at = number[ordered]
    size = lengths[at]
    same = size[1:] == size[:-1]
    last_open = following[at] >= len(part.text)
    same &= ~(last_open[1:] | last_open[:-1])
    pairs = np.flatnonzero(same)
    reach = 0
    wanted = size[1:]
    while len(pairs):
        equal = part.text[ordered[pairs] + reach] == part.text[ordered[pairs + 1] + reach]
        same[pairs[~equal]] = False
        reach += 1
        pairs = pairs[equal]
        pairs = pairs[wanted[pairs] > reach]
    names = np.concatenate([[0], np.cumsum(~same)])
    placed = np.empty(len(leftmost), np.int64)
    placed[at] = names
    return placed, int(names[-1]) + 1


def _ordered_leftmost(part: Typed, leftmost: np.ndarray, disk: Disk) -> np.ndarray:
    """The leftmost S suffixes in order, by induction over their stretches and recursion over the names."""
    if len(leftmost) < 2:
        return leftmost
    roughly, _ = induce(part, leftmost, disk)
    marked = disk.array(len(part.text), bool, 0)
    marked[leftmost] = True
    ordered = np.concatenate([
        block[marked[block]] for block in
        (np.array(roughly[at:at + _STRETCH]) for at in range(0, len(roughly), _STRETCH))
    ])
    names, kinds = _named(part, ordered, leftmost, disk)
    if kinds == len(leftmost):
        return ordered
    reduced = typed(names, kinds, disk)
    inner = _ordered_leftmost(reduced, reduced.leftmost, disk)
    queue, _ = induce(reduced, inner, disk)
    return leftmost[queue]


def suffixes(text: np.ndarray, kinds: int, cap: int, folder: str | None = None):
    """(suffixes in order, common prefix of each with the one before, at most ``cap``) of symbols < kinds.

    Scratch files go to a temporary folder of this task, which is removed with the results' last use.
    """
    if not len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    text = np.asarray(text)
    with tempfile.TemporaryDirectory(dir=folder) as scratch:
        disk = Disk(scratch)
        part = typed(text, kinds, disk)
        ordered = _ordered_leftmost(part, part.leftmost, disk)
        shared = np.zeros(len(ordered), np.int32)
        for at in range(1, len(ordered), _STRETCH):
            chosen = ordered[at:at + _STRETCH]
            shared[at:at + len(chosen)] = common_prefix(text, ordered[at - 1:at - 1 + len(chosen)], chosen, cap)
        queue, prefixes = induce(part, ordered, disk, shared, cap)
        return queue, prefixes[:len(text)]

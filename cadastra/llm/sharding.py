"""Shards of nearly equal bytes: the minimax partition of ordered atomic groups.

Documents with equal texts form a group that stays together. Groups lie in the order of their texts'
digests, which mixes sources evenly. The smallest capacity for which a greedy pass needs no more than
the wanted shards is found by binary search.

The pass runs over a table of group ends that is too large for one place, so it works on a bounded
summary: the lowest and highest end in each of at most ``SUMMARY`` intervals. A cut inside an interval
is known up to the interval, which gives a capacity that surely suffices and one that may; intervals
on which the answer still hangs are summarized again, finer, until both meet. Column expressions only.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadastra.shared import stage

SUMMARY = 1 << 15
ROW_BYTES = 16


class Ends:
    """Sorted intervals (lowest, highest) that hold all group ends, both ends being group ends."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans = sorted(spans)
        self.low = [low for low, _ in self.spans]

    @property
    def total(self) -> int:
        return self.spans[-1][1] if self.spans else 0

    def reach(self, limit: int, hopeful: bool) -> int:
        """The last group end up to ``limit``: a sure lower or, if ``hopeful``, an upper bound."""
        at = bisect_right(self.low, limit) - 1
        if at < 0:
            return 0
        low, high = self.spans[at]
        return high if high <= limit else limit if hopeful else low

    def cuts(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        """Ends of the shards that a greedy pass fills; the last is the total if all fits."""
        found, start = [], 0
        for _ in range(shards):
            start = self.reach(start + capacity, hopeful)
            found.append(start)
        return found

    def least(self, shards: int, hopeful: bool) -> int:
        """The smallest capacity for which the pass reaches the end."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, hopeful)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low


def _summary(ends: DataFrame, windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Lowest and highest end per interval within the windows, about ``SUMMARY`` of them."""
    width = max(1, sum(high - low + 1 for low, high in windows) // SUMMARY)
    inside = F.lit(False)
    for low, high in windows:
        inside = inside | F.col("end").between(low, high)
    spans = ends.where(inside).groupBy(F.floor(F.col("end") / F.lit(width)).alias("_at")).agg(
        F.min("end").alias("low"), F.max("end").alias("high")
    )
    return [(row["low"], row["high"]) for row in spans.select("low", "high").collect()]


def smallest_capacity(ends: DataFrame, total: int, shards: int) -> tuple[int, Ends]:
    """The smallest shard capacity over the column ``end`` of group ends, and the ends known by then."""
    known = Ends(_summary(ends, [(1, total)]))
    while True:
        maybe, surely = known.least(shards, True), known.least(shards, False)
        if maybe == surely:
            return surely, known
        open_spans = set()
        for low, high in zip(known.cuts(maybe, shards, False), known.cuts(surely, shards, True)):
            first = max(0, bisect_right(known.low, low) - 1)
            for at in range(first, bisect_right(known.low, high)):
                if known.spans[at][0] < known.spans[at][1]:
                    open_spans.add(at)
        windows: list[tuple[int, int]] = []
        for at in sorted(open_spans):
            low, high = known.spans[at]
            if windows and at - 1 in open_spans:
                windows[-1] = (windows[-1][0], high)
            else:
                windows.append((low, high))
        # A condition of a hundred windows at most: neighbours across the smallest gaps are joined.
        while len(windows) > 100:
            at = min(range(1, len(windows)), key=lambda i: windows[i][0] - windows[i - 1][1])
            windows[at - 1:at + 1] = [(windows[at - 1][0], windows[at][1])]
        rest = [s for s in known.spans if not any(low <= s[0] <= high for low, high in windows)]
        known = Ends(rest + _summary(ends, windows))


def even_cuts(known: Ends, capacity: int, shards: int) -> list[int]:
    """Shard ends within the capacity, each as near as it can be to an even share of what is left.

    A single group larger than an even share sets the capacity; filling every shard up to it would leave
    the last shards empty.
    """
    ends = sorted({end for span in known.spans for end in span})
    total = known.total
    # The earliest end after which the rest still fits into the shards that remain.
    latest = [total]
    for _ in range(shards - 1):
        at = bisect_left(ends, latest[-1] - capacity)
        latest.append(0 if latest[-1] <= capacity else ends[at])
    earliest = latest[::-1]
    found, start = [], 0
    for shard in range(shards):
        wanted = start + -(-(total - start) // (shards - shard))
        at = bisect_left(ends, wanted)
        near = min((e for e in ends[max(0, at - 1):at + 1]), key=lambda e: (abs(e - wanted), e), default=total)
        farthest = ends[bisect_right(ends, start + capacity) - 1] if ends and ends[0] <= start + capacity else start
        start = min(max(near, earliest[shard], start), max(farthest, start))
        found.append(start)
    return found


def shard_documents(docs: DataFrame, shards: int = 40, text: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes plus 16. Equal texts share a shard, all null texts being equal
    to one another and apart from the empty text, whose checksum they share. Slots count from 0 in each
    shard in order of digest, then doc_id (null first); equal rows are told apart by their place in the
    input. Fewer groups than shards leave shards empty; an empty table gives an empty result. Other
    columns are not read. The law is ``bytes``, so ``grown_shard`` is null.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    narrow = stage(docs.select(
        "doc_id",
        (F.octet_length(whole) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(whole).alias("text_crc32"),
        F.unhex(F.sha2(F.col(text), 256)).alias("digest"),
    ), "sizes")
    order = ["digest", "doc_id", "tie"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(
        narrow.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()),
        "ordered",
    )
    per_part = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(per_part.select(
        "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
    ), "offsets")
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = stage(placed.join(offsets, "part").select(
        "doc_id", "size", "text_crc32", "digest",
        (F.col("bytes_before") + F.sum("size").over(inside)).alias("through"),
        (F.col("rows_before") + F.count(F.lit(1)).over(inside)).alias("place"),
    ), "running")
    ends = stage(running.groupBy("digest").agg(F.max("through").alias("end")).select("end"), "ends")
    total = ends.agg(F.max("end")).first()[0] or 0
    cuts = []
    if total:
        capacity, known = smallest_capacity(ends, total, shards)
        cuts = even_cuts(known, capacity, shards)
    ends_before = F.filter(F.lit(cuts[:-1]).cast("array<long>"), lambda cut: cut < F.col("through"))
    shard = F.size(ends_before) if cuts[:-1] else F.lit(0)
    numbered = running.withColumn("shard", shard)
    starts = stage(numbered.groupBy("shard").agg(F.min("place").alias("start")), "starts")
    return numbered.join(starts, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("start")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""Benchmark passages in documents: SimHash windows, multi-index Hamming blocks, exact weighted similarity.

1. Windows. Windows have an item's size in shingles. One similar enough to any item shares most shingles with it, and
   moving it right to its first shared shingle never lowers its similarity; so only windows that start at a shared
   shingle and hold the least number of shared ones that the threshold implies are fingerprinted. Windows end early at the
   end of a text.
2. Blocks. Fingerprints of windows and items are cut into segments, and every item is put under all values of a small
   Hamming ball around each of its segments; a window meets all items of its size within the radius, none is missed.
3. The rest. A fingerprint tells little of few or repeated shingles: such items and windows, and windows cut by the
   end of a text, may be similar at any distance. They meet the items whose shingles listed them, whatever their bits.
4. Check. The weighted similarity of the shingle multisets, sum of least counts over sum of greatest, of every pair.

Texts are read twice; what is shuffled grows with the matches, or with the shingles where the benchmark
is too large for Spark's own broadcast threshold. Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import let, words_of
from cadastra.llm.hamming import balls, entries, search_plan
from cadastra.shared import stage

SHINGLE = 5
SIMILARITY = 0.8
# Whole windows of distinct shingles at 0.8 differ from their item by 9.7 bits in the mean, with a deviation of 2.9.
RADIUS = 22
SEGMENTS = 8
# Items of fewer shingles have fingerprints that a single shingle turns.
LEAST_SHINGLES = 12

# Bit b is set if more than half of the hashes have it.
_SIMHASH = """aggregate(sequence(0, 63), 0L, (print, b) -> print | if(
    2 * aggregate(hashes, 0, (n, h) -> n + cast(shiftright(h, b) & 1L AS int)) > size(hashes),
    shiftleft(1L, b), 0L))"""


def grams(text: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words of the lower-cased text, in order."""

    def hashed(words: Column) -> Column:
        whole = F.slice(words, F.lit(1), F.greatest(F.size(words) - (width - 1), F.lit(0)))
        return F.transform(whole, lambda word, at: F.xxhash64(word, *[words[at + i] for i in range(1, width)]))

    return let(words_of(F.lower(text)), hashed)


def text_digest(text: Column) -> Column:
    """16 bytes that stand for a text; null for a null."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _item_hashes(items: DataFrame, widths: list[int]) -> DataFrame:
    """(item_id, width, hashes) of every item with a word; short items are one shingle, whole."""
    hashes = F.when(F.lit(False), F.lit(None).cast("array<long>"))
    for width in widths:
        hashes = hashes.when(F.col("width") == width, grams(F.col("text"), width))
    return items.where("width > 0").select("item_id", "width", hashes.alias("hashes"))


def _repeats(hashes: str) -> Column:
    return F.size(F.array_distinct(hashes)) < F.size(hashes)


def leaks(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS,
          segments: int = SEGMENTS, least_shingles: int = LEAST_SHINGLES) -> DataFrame:
    """(digest, item_id, similarity, bits, first_word) of the best window per text and benchmark item.

    ``docs`` needs the column text, ``items`` item_id and text; others are not read. A text stands for
    all documents that have it, by :func:`text_digest`. Null and empty texts and items match nothing;
    rows repeated in either table change nothing; items without an id are left out; several texts under
    one item_id are items of their own and the best of them counts. The window nearest the start wins ties.
    ``radius`` holds for whole windows of distinct shingles and items of at least ``least_shingles`` distinct ones.
    """
    worded = items.select("item_id", "text").where("item_id IS NOT NULL").distinct().withColumn(
        "width", F.least(F.size(words_of(F.lower("text"))), F.lit(SHINGLE))
    )
    widths = [row["width"] for row in worded.where("width > 0").select("width").distinct().collect()]
    known = stage(
        _item_hashes(worded, widths).withColumn("fp", F.expr(_SIMHASH))
        .withColumn("version", F.xxhash64("item_id", "hashes")).dropDuplicates(["item_id", "version"]), "items",
    )
    sizes = stage(known.select(
        "item_id", "version", "width", F.size("hashes").alias("size"), F.col("fp").alias("item_fp"),
        (~_repeats("hashes") & (F.size("hashes") >= least_shingles)).alias("regular"),
    ), "sizes")
    shingles = stage(
        known.select("item_id", "version", "width", F.explode("hashes").alias("h"))
        .groupBy("item_id", "version", "width", "h").agg(F.count(F.lit(1)).alias("weight")), "shingles",
    )
    texts = docs.select("text").where("text IS NOT NULL").withColumn("digest", text_digest(F.col("text")))

    wanted = stage(shingles.select("width", "h").distinct(), "wanted")
    shared = None
    for width in widths:
        hashed = texts.select("digest", grams(F.col("text"), width).alias("hashes"))
        placed = hashed.select("digest", F.size("hashes").alias("total"), F.posexplode("hashes").alias("at", "h"))
        found = placed.join(wanted.where(F.col("width") == width), "h").select("digest", "total", "at", "h", "width")
        shared = found if shared is None else shared.unionAll(found)
    if shared is None:
        return docs.sparkSession.createDataFrame(
            [], "digest binary, item_id long, similarity double, bits int, first_word int"
        )
    shared = stage(shared, "shared")

    per_item = shared.join(shingles, ["width", "h"]).groupBy("digest", "item_id", "version", "width").agg(
        F.collect_set("at").alias("places"), F.max("total").alias("total")
    ).join(sizes, ["item_id", "version", "width"])

    def enough(place: Column) -> Column:
        inside = F.least(F.col("size"), F.col("total") - place)
        return F.ceil((F.col("size") + inside) * F.lit(similarity / (1 + similarity)) - 1e-9).cast("int")

    starts = let(F.sort_array("places"), lambda places: F.filter(
        places, lambda place, at: F.get(places, at + enough(place) - 1) < place + F.col("size")
    ))
    window = ["digest", "width", "size", "start"]
    pairs = stage(
        per_item.select(
            "digest", "width", "size", F.explode(starts).alias("start"), "item_id", "version", "item_fp", "regular"),
        "pairs",
    )
    wide = stage(
        pairs.select(*window).distinct().groupBy("digest", "width", "size").agg(F.collect_list("start").alias("starts")),
        "windows",
    )

    # One text per digest; the windows' texts are few, and join by Spark's own size check.
    needed = texts.join(wide.select("digest").distinct(), "digest", "left_semi").groupBy("digest").agg(
        F.first("text").alias("text")
    )
    cut = None
    for width in widths:
        own = needed.join(wide.where(F.col("width") == width), "digest")
        hashed = own.select("digest", "width", "size", "starts", grams(F.col("text"), width).alias("all"))
        windows = hashed.select("digest", "width", "size", "all", F.explode("starts").alias("start")).select(
            "digest", "width", "size", "start", F.expr("slice(all, start + 1, size)").alias("hashes")
        )
        cut = windows if cut is None else cut.unionAll(windows)
    odd = _repeats("hashes") | (F.size("hashes") < F.col("size"))
    printed = stage(cut.withColumns({"fp": F.expr(_SIMHASH), "odd": odd}), "printed")

    bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    plan, pair = search_plan(radius, segments), [*window, "item_id", "version", bits.alias("bits")]
    probes = balls(entries(sizes.where("regular").drop("regular"), "item_fp", plan), plan)
    near = entries(printed.where("NOT odd").select(*window, "fp"), "fp", plan).join(
        probes, ["segment", "key", "width", "size"]
    ).where(bits <= radius).select(*pair).distinct()
    listed = pairs.join(printed.select(*window, "fp", "odd"), window).where("odd OR NOT regular").select(*pair)
    weights = near.unionAll(listed).join(printed.select(*window, "hashes"), window).select(
        *window, "item_id", "version", "bits", F.size("hashes").alias("inside"), F.explode("hashes").alias("h")
    ).groupBy(*window, "item_id", "version", "bits", "inside", "h").agg(F.count(F.lit(1)).alias("own"))
    common = weights.join(shingles, ["item_id", "version", "width", "h"]).groupBy(
        *window, "item_id", "version", "bits", "inside"
    ).agg(F.sum(F.least("own", "weight")).alias("common"))
    union = F.col("inside") + F.col("size") - F.col("common")
    judged = common.where(F.col("common") >= similarity * union - 1e-9).withColumn(
        "similarity", F.col("common") / union
    )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), (-F.col("bits")).alias("nearness")))
    return judged.groupBy("digest", "item_id").agg(best.alias("best")).select(
        "digest", "item_id", "best.similarity",
        (-F.col("best.nearness")).alias("bits"), (-F.col("best.back")).alias("first_word"),
    )


def contaminated(docs: DataFrame, items: DataFrame, **parameters) -> DataFrame:
    """(doc_id, item_id, similarity, bits, first_word) of every document that holds an item."""
    found = stage(leaks(docs, items, **parameters), "leaks")
    return docs.select("doc_id", text_digest(F.col("text")).alias("digest")).join(found, "digest").drop("digest")


def without_leaks(docs: DataFrame, items: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, in their own columns; null texts stay."""
    found = stage(leaks(docs, items, **parameters).select(F.col("digest").alias("__leaked")).distinct(), "leaked")
    return docs.join(found, text_digest(F.col("text")) == F.col("__leaked"), "left_anti")

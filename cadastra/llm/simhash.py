"""SimHash near-duplicates found by multi-index hashing.

A fingerprint is cut into segments. Two fingerprints within ``radius`` bits agree on some segment up
to a small number of bits, so for each segment the Hamming ball of that size around its value is
enumerated, matches are fetched from the table of segment values, and the complete distance is
verified. With three segments and radius 4: one bit in either of the first two, none in the third.

* Only distinct fingerprints are linked; texts are read once and never shuffled.
* A segment value shared by more than ``block`` fingerprints is dealt out over many tasks, both sides
  salted; each returns a spanning forest of its links, not all pairs. One shared by more than ``parts`` blocks
  is searched by balls and tables again, over the bits outside the segment. Nothing is capped.
* Tables with a row or more per fingerprint are joined by merge. Spark sizes them by their packed files, and what is
  exploded as if it were not, so it would broadcast millions of probes. Crowded values are counted first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.llm.components import components
from cadastra.llm.hamming import BITS, balls, entries, rest, search_plan
from cadastra.shared import stage

SEED = 42
# Hashes whose bits are counted at once.
_CHUNK = 1 << 15
# Distinct fingerprints up to which three segments are taken.
WIDE = 100_000_000
# Bits outside a segment from which a large cell is searched by them.
LEAST_BITS = 24
# Crowded values, some 130 bytes each to Spark, up to which they are sent to all executors.
SENT = 500_000


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of the word shingles, repeats included, as a signed 64-bit integer; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = (np.cumsum([len(word) + 1 for word in words]) - 1).tolist()
    starts = [0, *(end + 1 for end in ends)]
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:])]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = np.array(hashes[at:at + _CHUNK], np.uint64)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 4, name: str = "fingerprint") -> DataFrame:
    """The rows of ``docs`` with their fingerprint as a last column, a long."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(value.as_py(), shingle) for value in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.int64())], [*batch.schema.names, name]
            )

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    return docs.mapInArrow(add, schema)


def _forest(radius: int):
    """Spanning forest of the links among the fingerprints of one block, by breadth-first search."""

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        left = np.unique(rows["fp"].to_numpy())
        pairs = []
        while len(left):
            root, left = left[0], left[1:]
            queue = [root]
            while queue and len(left):
                near = np.bitwise_count(left.view(np.uint64) ^ np.uint64(int(queue.pop()) & (2**64 - 1))) <= radius
                if near.any():
                    reached, left = left[near], left[~near]
                    queue.extend(reached)
                    pairs.extend((root, node) for node in reached)
        return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")

    return grow


def links(fps: DataFrame, radius: int = 4, segments: int | None = None, block: int = 512, parts: int = 8) -> DataFrame:
    """(a, b) connecting all distinct values of the long column ``fp`` within ``radius`` bits.

    Pairs need not be all pairs: what is connected by links is connected by the pairs returned, and
    nothing else. More than ``segments`` shortens the balls, fewer lengthens the keys; where None, 3 are taken up
    to ``WIDE`` fingerprints and 2 (529 and 33 probes on 32-bit keys) beyond.
    """
    if segments is None:
        segments = 3 if fps.count() <= WIDE else 2
    values = fps.select(F.lit("").alias("within"), F.col("fp").alias("value"), "fp")
    return _search(values, values, BITS, radius, segments, block, parts)


def _search(
    held: DataFrame, sought: DataFrame, width: int, radius: int, segments: int, block: int, parts: int
) -> DataFrame:
    """Links (a, b) between rows of two tables (within, value, fp) of equal ``within`` and ``width``-bit values.

    Cells are values of a segment. Those of at most ``block`` held rows are joined with what probes them (Spark
    splits the probes where they are many), those of up to ``parts`` blocks are dealt out, and larger ones are searched again by the bits outside the segment.
    So the rows moved grow with the fingerprints, not with the square of a cell. Where few bits are
    left, a cell has at most two to their number of rows, and is dealt out.
    """
    plan, cell = search_plan(radius, segments, width), ["within", "segment", "key"]
    left = width - min(w for _, w, _ in plan)
    listed = entries(held, "value", plan)
    probing = balls(entries(sought, "value", plan), plan)
    crowded = stage(listed.groupBy(cell).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block), "crowded")
    # How many parts a crowded cell's rows need, and its probes, of which most come from crowded cells around it.
    probes = balls(crowded, plan).groupBy(cell).agg(F.sum("n").alias("probes")).hint("merge")
    hot = stage(
        crowded.join(probes, cell).select(
            *cell,
            F.ceil(F.col("n") / block).cast("int").alias("entry_parts"),
            (F.ceil(F.col("probes") / (8 * block)) + 1).cast("int").alias("probe_parts"),
        ), "hot",
    )

    def joined(entered: DataFrame, probed: DataFrame) -> DataFrame:
        near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= radius
        met = entered.select(*cell, "fp").join(probed.select(*cell, F.col("fp").alias("other")).hint("merge"), cell)
        return met.where((F.col("fp") < F.col("other")) & near).select(F.col("fp").alias("a"), F.col("other").alias("b"))

    cells = hot.count()
    if not cells:
        return joined(listed, probing)
    # By rows, not by files: Spark may take the probes, which it sizes too low, for the smaller side.
    hot = hot.hint("broadcast" if cells <= SENT else "merge")
    marked, probing = listed.join(hot, cell, "left"), probing.join(hot, cell, "left")
    found = joined(marked.where("entry_parts IS NULL"), probing.where("entry_parts IS NULL"))
    deeper = F.col("entry_parts") > parts
    if left <= LEAST_BITS or hot.where(deeper).isEmpty():
        deeper = F.lit(False)
    else:
        inner = F.concat_ws(":", *cell).alias("within"), rest("value", plan).alias("value"), "fp"
        again = [stage(df.where(deeper).select(*inner), "cells") for df in (marked, probing)]
        found = found.unionAll(_search(*again, left, radius, segments, block, parts))

    def part(count: str, seed: int) -> Column:
        return F.pmod(F.xxhash64("fp", F.lit(seed)), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    shallow = F.col("entry_parts").isNotNull() & ~deeper
    dealt = marked.where(shallow).select(
        *cell, part("entry_parts", 1).alias("i"), every("probe_parts").alias("j"), "fp"
    ).unionAll(
        probing.where(shallow).select(*cell, every("entry_parts").alias("i"), part("probe_parts", 2).alias("j"), "fp")
    )
    return found.unionAll(dealt.groupBy(*cell, "i", "j").applyInPandas(_forest(radius), "a long, b long"))


def near_duplicates(
    docs: DataFrame, radius: int = 4, shingle: int = 4, segments: int | None = None, block: int = 512
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest doc_id reachable over links, the document's own included. A null
    text counts as empty; texts without a word share the fingerprint zero and are linked like any
    other. Rows with a null doc_id take part and get the smallest doc_id of their component, null if
    it has none. Repeated rows each get a row. Other columns are not read.
    """
    printed = stage(with_fingerprint(docs.select("doc_id", "text"), shingle=shingle, name="fp").drop("text"), "fingerprints")
    # Staged, so that Spark can split the rows of a fingerprint that many documents have.
    reps = stage(representatives(printed, radius, segments, block), "representatives")
    return printed.join(reps.hint("merge"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def representatives(printed: DataFrame, radius: int = 4, segments: int | None = None, block: int = 512) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of ``printed`` (doc_id, fp).

    ``root`` is the least fingerprint of the component, ``component_id`` its smallest doc_id.
    """
    least = stage(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    linked = stage(links(least.select("fp"), radius, segments, block).distinct(), "links")
    roots = components(linked).withColumnRenamed("node", "fp")
    members = stage(roots.join(least.hint("merge"), "fp"), "members")
    smallest = members.groupBy("root").agg(F.min("least").alias("component_id"))
    reached = members.join(smallest.hint("merge"), "root").select("fp", "root", "component_id")
    return least.join(reached.hint("merge"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id")
    )


def one_of_each(docs: DataFrame, radius: int = 4, shingle: int = 4, segments: int | None = None, block: int = 512) -> DataFrame:
    """One row of ``docs`` per component, in its own columns: that with the smallest doc_id.

    Among rows that share that id, or in a component without any id, the least of the rows' digests
    decides, and of equal rows one stays. A null text counts as empty. Texts are shuffled once, by
    fingerprint, against one row per fingerprint.
    """
    columns = docs.columns
    printed = stage(with_fingerprint(docs, shingle=shingle, name="__fp"), "fingerprints")
    held = [F.col(f"`{name}`") for name in columns]
    whole = F.xxhash64(*held, *[column.isNull() for column in held])
    narrow = printed.select("doc_id", F.col("__fp").alias("fp"), whole.alias("row"))
    reps = stage(representatives(narrow.select("doc_id", "fp"), radius, segments, block), "representatives")
    # Rows that carry their component's id: usually one, the least by (fingerprint, row) where several.
    heads = narrow.join(reps.hint("merge"), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = stage(
        heads.groupBy("root").agg(F.min(F.struct("fp", "row")).alias("head"))
        .select(F.col("head.fp").alias("__head_fp"), F.col("head.row").alias("__head_row")), "chosen",
    )
    kept = printed.join(
        chosen, (F.col("__fp") == F.col("__head_fp")) & (whole == F.col("__head_row")), "left_semi"
    )
    repeated = narrow.groupBy("fp", "row").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    twice = stage(repeated.select(F.col("fp").alias("__head_fp"), F.col("row").alias("__head_row")), "repeated")
    same = (F.col("__fp") == F.col("__head_fp")) & (whole == F.col("__head_row"))
    single = kept.join(twice, same, "left_anti").select(*columns)
    if twice.isEmpty():
        return single
    return single.unionByName(kept.join(twice, same, "left_semi").select(*columns).distinct())

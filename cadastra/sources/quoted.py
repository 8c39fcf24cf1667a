"""Records of delimited text whose quoted values hold line breaks, read split by split.

A split of a file may begin inside a value, which only the text before it tells. So every line is judged for both cases:
whether it ends inside a value if it begins outside one, and if it begins inside one. Most lines leave the state as it
is, some turn it, some fix it. The effect of a split is put together from its lines, the state at its start from the splits
before it, which are a small table, and then each line is known to begin a record or to continue one. Only the lines of
records with line breaks are brought together; all others stay where they were read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadastra.operators.joins import attach
from cadastra.shared import stage

# A quote that opens a value of more lines than this is taken for a plain character.
MAX_LINES = 10_000
_SPLIT = "spark.sql.files.maxPartitionBytes"
_AT = ["file", "block"]


@contextmanager
def _split_size(spark: SparkSession, size: int | None) -> Iterator[None]:
    before = spark.conf.get(_SPLIT)
    if size:
        spark.conf.set(_SPLIT, str(size))
    try:
        yield
    finally:
        spark.conf.set(_SPLIT, before)


def _ends_inside(text: Column, delimiter: str, quote: str) -> tuple[Column, Column]:
    """Whether a line ends inside a value: if it begins outside one, and if it begins inside one.

    A quote opens a value only at its start. What stands between a closing quote and the next delimiter belongs to
    the value, as in a tolerant reader.
    """
    d, q = re.escape(delimiter), re.escape(quote)
    inside = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"
    value = f"(?:{q}{inside}{q}(?!{q})[^{d}]*+|(?!{q})[^{d}]*+)"
    opened = f"^(?:{value}{d})*+{q}{inside}$"
    rest = F.regexp_replace(text, f"(?s)^{inside}{q}[^{d}]*+({d}|$)", "$1")
    # The rest begins with the delimiter behind the value that ended, so it is judged as behind an empty value.
    return text.rlike(f"(?s){opened}"), text.rlike(f"(?s)^{inside}$") | (rest.startswith(delimiter) & rest.rlike(f"(?s){opened}"))


def _lines(spark: SparkSession, path: str, delimiter: str, quote: str, split_bytes: int | None) -> DataFrame:
    """All physical lines with their place, and how they change the state."""
    read = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), "value",
    )
    outside, inside = _ends_inside(F.regexp_replace("value", "\r$", ""), delimiter, quote)
    quoted = F.contains("value", F.lit(quote))
    judged = read.select("*", (quoted & outside).alias("from_out"), (~quoted | inside).alias("from_in"))
    with _split_size(spark, split_bytes):
        return stage(judged, "lines")


def _stated(lines: DataFrame) -> DataFrame:
    """Each line with the state it begins in, as far as its own split tells, and whether the split's start turns it.

    A line that ends the same way from either state fixes it; one that ends the other way turns it.
    """
    order = Window.partitionBy(*_AT).orderBy("seq")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    fixes = F.col("from_out") == F.col("from_in")
    turns = (F.col("from_out") & ~F.col("from_in")).cast("int")
    turned = lines.withColumn("turned", F.sum(turns).over(order))
    fixed = turned.withColumn("fixed", F.last(
        F.when(fixes, F.struct(F.col("from_out").cast("int").alias("state"), "turned")), ignorenulls=True).over(ahead))
    before = F.coalesce(F.col("turned") - turns, F.lit(0))
    return fixed.select(
        *_AT, "seq", "value", "from_out", "from_in",
        ((F.col("fixed.state") + before - F.col("fixed.turned")) % 2).alias("known"), (before % 2).alias("parity"),
    )


def _split_starts(stated: DataFrame) -> DataFrame:
    """The state at the start of every split: 1 inside a value."""
    last = stated.groupBy(*_AT).agg(F.max_by(F.struct("known", "parity", "from_out", "from_in"), "seq").alias("last"))

    def end(start: int) -> Column:
        before = F.coalesce(F.col("last.known"), (F.col("last.parity") + start) % 2)
        return F.when(before == 1, F.col("last.from_in")).otherwise(F.col("last.from_out")).cast("int")

    splits = stage(last.select(*_AT, end(0).alias("from_out"), end(1).alias("from_in")), "splits")
    order = Window.partitionBy("file").orderBy("block")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = ((F.col("from_out") == 1) & (F.col("from_in") == 0)).cast("int")
    turned = splits.withColumn("turned", F.sum(turns).over(order))
    fixed = turned.withColumn("fixed", F.last(
        F.when(F.col("from_out") == F.col("from_in"), F.struct(F.col("from_out").alias("state"), "turned")),
        ignorenulls=True).over(ahead))
    before = F.col("turned") - turns
    start = F.coalesce(F.col("fixed.state") + before - F.col("fixed.turned"), before) % 2
    return stage(fixed.select(*_AT, start.alias("start")), "split-starts")


def records(spark: SparkSession, path: str, delimiter: str, quote: str = '"', max_lines: int = MAX_LINES,
            split_bytes: int | None = None) -> DataFrame:
    """(file, block, seq, record, first): the records of one or more files; ``first`` marks the first of a file.

    The lines of a record of more than ``max_lines`` lines, as a quote that is never closed makes, are records by
    themselves. Blank lines between records are left out. ``split_bytes`` is the size of a split, by default the session's.
    """
    stated = stage(_stated(_lines(spark, path, delimiter, quote, split_bytes)), "stated")
    begun = attach(stated, _split_starts(stated), _AT).withColumn(
        "inside", F.coalesce(F.col("known"), (F.col("parity") + F.col("start")) % 2) == 1)
    open_ = F.when(F.col("inside"), F.col("from_in")).otherwise(F.col("from_out"))
    placed = begun.select(*_AT, "seq", "value", "inside", open_.alias("open"))
    # Lines that neither continue a record nor leave one open are records as they stand.
    single = placed.where("NOT inside AND NOT open").select(*_AT, "seq", F.col("value").alias("record"))

    pieces = stage(placed.where("inside OR open").withColumn(
        "begin", F.when(~F.col("inside"), F.struct(*_AT[1:], "seq"))), "pieces")
    own = F.last("begin", ignorenulls=True).over(Window.partitionBy(*_AT).orderBy("seq"))
    carried = stage(pieces.groupBy(*_AT).agg(F.max("begin").alias("begin")).select(*_AT, F.last(
        "begin", ignorenulls=True).over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("carried")), "carried")
    keyed = attach(pieces.withColumn("own", own), carried, _AT).withColumn("of", F.coalesce("own", "carried"))
    counted = stage(keyed.groupBy("file", "of").agg(F.count(F.lit(1)).alias("n")), "counts")
    sized = attach(keyed, counted, ["file", "of"])
    whole = sized.where(F.col("n") <= max_lines).groupBy("file", "of").agg(
        F.sort_array(F.collect_list(F.struct("block", "seq", "value"))).alias("lines"))
    joined = whole.select(
        "file", F.col("of.block").alias("block"), F.col("of.seq").alias("seq"), F.array_join("lines.value", "\n").alias("record"))
    alone = sized.where(F.col("n") > max_lines).select(*_AT, "seq", F.col("value").alias("record"))
    every = single.unionByName(joined).unionByName(alone).withColumn(
        "record", F.regexp_replace("record", "\r$", "")).where("record <> ''")
    heads = stage(every.where("block = 0").groupBy("file").agg(F.min("seq").alias("head")), "heads")
    return attach(every, heads, ["file"]).select(
        *_AT, "seq", "record", ((F.col("block") == 0) & (F.col("seq") == F.col("head"))).alias("first"))

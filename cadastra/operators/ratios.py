"""Ratio studies: assessment-to-sale ratios, COD, PRD, and exact medians of groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cadastra.operators.joins import attach
from cadastra.operators.ordered import ROWS_PER_PLACE, choose_strategy
from cadastra.shared import stage

# A group's exact median is kept in memory as value counts up to this many rows.
MEDIAN_ROWS = 200_000
# Steps into which a scan parts the range that holds a group's middle rows.
STEPS = 4_096


def sales_ratio(value: Column, price: Column) -> Column:
    """Value over price; NULL without a positive price."""
    return F.when(price > 0, value.cast("double") / price.cast("double"))


def _step(value: Column, low: Column, high: Column, kind: T.DataType, steps: int) -> Column:
    """In which of ``steps`` equal steps of the range a value lies; never falls as values rise.

    Differences are taken in the value's own type, so the ends of a range always lie in different steps.
    """
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # Halves, as the width of a range may exceed the largest double.
        value, low, high = value.cast("double") / 2, low.cast("double") / 2, high.cast("double") / 2
    elif isinstance(kind, T.IntegralType):
        value, low, high = (c.cast("decimal(20,0)") for c in (value, low, high))
    share = (value - low).cast("double") / (high - low).cast("double")
    return F.least(F.floor(share * steps).cast("int"), F.lit(steps - 1))


def _inside(rows: DataFrame, ranges: DataFrame, by: list[str], value: str) -> DataFrame:
    """The rows of open groups that lie in the range of their group."""
    return attach(rows, ranges, by).filter(F.col(value).between(F.col("_low"), F.col("_high")))


def _refined(inside: DataFrame, by: list[str], value: str, steps: int) -> DataFrame:
    """The step that holds the middle rows of each group: its range, rows and rows before it.

    Where the two middle rows lie in neighbouring steps, they are the greatest value of the one and the least of the
    other. Counts per step are all that is shuffled.
    """
    kind = inside.schema[value].dataType
    step = _step(F.col(value), F.col("_low"), F.col("_high"), kind, steps)
    counted = inside.groupBy(*by, "_before", "_rank", "_even", step.alias("_step")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(value).alias("_least"), F.max(value).alias("_most"))
    order = Window.partitionBy(*by).orderBy("_step")
    ranged = counted.withColumns({
        "_upto": F.col("_before") + F.sum("_rows").over(order),
        "_following": F.lead("_least").over(order),
    }).withColumn("_first", F.col("_upto") - F.col("_rows"))
    held = ranged.filter((F.col("_first") < F.col("_rank")) & (F.col("_rank") <= F.col("_upto")))
    apart = F.col("_even") & (F.col("_rank") == F.col("_upto"))
    return held.select(
        *by, F.col("_first").alias("_before"), "_rank", "_even", "_rows", F.col("_least").alias("_low"),
        F.col("_most").alias("_high"),
        F.when(apart, F.array("_most", "_following")).when(F.col("_least") == F.col("_most"), F.array("_least"))
        .alias("_middles"),
    )


def _sorted_out(inside: DataFrame, by: list[str], value: str) -> DataFrame:
    """The middle values of groups whose range holds few rows."""
    listed = inside.groupBy(*by, "_before", "_rank", "_even").agg(F.sort_array(F.collect_list(value)).alias("_listed"))
    at = (F.col("_rank") - F.col("_before")).cast("int")
    return listed.select(*by, F.slice("_listed", at, 1 + F.col("_even").cast("int")).alias("_middles"))


def grouped_median(
    df: DataFrame, by: list[str], value: str, out: str, strategy: str = "auto",
    plain_rows: int = MEDIAN_ROWS, rows_per_place: int = ROWS_PER_PLACE, staged: bool = False,
    steps: int = STEPS,
) -> DataFrame:
    """Exact interpolated median of the non-NULL finite values per group.

    Large groups: rows are counted by the step of their group's range in which they lie, and the step with the middle
    row is the range of the next scan, until it holds one value or at most ``rows_per_place`` rows, which are sorted.
    Each scan cuts the ranges to one part in ``steps``; no group is sorted, and no row is shuffled before
    that. ``staged=True`` says that ``df`` is already a cheap scan of written files.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*by, value)
    if choose_strategy(rows, by, strategy, plain_rows) == "plain":
        return rows.groupBy(*by).agg(F.median(value).alias(out))

    source = rows if staged else stage(rows, "values")
    ends = source.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(value).alias("_low"), F.max(value).alias("_high"))
    state = stage(ends.filter("_rows > 0").select(
        *by, F.lit(0).cast("long").alias("_before"), F.expr("(_rows + 1) div 2").alias("_rank"),
        (F.col("_rows") % 2 == 0).alias("_even"), "_rows", "_low", "_high",
        F.when(F.col("_low") == F.col("_high"), F.array("_low")).alias("_middles"),
    ), "ranges")
    found = state.filter("_middles IS NOT NULL").select(*by, "_middles")
    ranges = state.filter("_middles IS NULL").drop("_middles")
    while True:
        most = ranges.agg(F.max("_rows")).first()[0] or 0
        few = most <= rows_per_place
        inside = _inside(source, ranges.drop("_rows"), by, value)
        if few:
            found = found.unionByName(_sorted_out(inside, by, value)) if most else found
            return found.select(*by, F.aggregate(
                "_middles", F.lit(0.0), lambda total, v: total + v.cast("double"),
                lambda total: total / F.size("_middles")).alias(out))
        state = stage(_refined(inside, by, value, steps), "ranges")
        found = found.unionByName(state.filter("_middles IS NOT NULL").select(*by, "_middles"))
        ranges = state.filter("_middles IS NULL").drop("_middles")


def ratio_table(
    df: DataFrame, by: list[str], assessed: str, price: str
) -> DataFrame:
    """Group columns, assessed value, price and ratio of the sales that have a ratio."""
    ratio = sales_ratio(F.col(assessed), F.col(price))
    return df.select(
        *by, F.col(assessed).alias("_av"), F.col(price).alias("_sp"), ratio.alias("_ratio")
    ).filter(F.col("_ratio").isNotNull())


def cod(df: DataFrame, by: list[str], assessed: str, price: str, **median) -> DataFrame:
    """Coefficient of dispersion: mean distance from the median ratio, in percent of the median."""
    return ratio_study(df, by, assessed, price, **median).select(*by, "cod")


def prd(df: DataFrame, by: list[str], assessed: str, price: str) -> DataFrame:
    """Price-related differential: mean ratio over weighted mean ratio."""
    sums = ratio_table(df, by, assessed, price).groupBy(*by).agg(*_means())
    return sums.select(*by, _prd())


def _means() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("sales"),
        F.avg("_ratio").alias("mean_ratio"),
        (F.sum("_av").cast("double") / F.sum("_sp").cast("double")).alias("weighted_mean_ratio"),
    ]


def _prd() -> Column:
    weighted = F.col("weighted_mean_ratio")
    return F.when(weighted != 0, F.col("mean_ratio") / weighted).alias("prd")


def ratio_study(df: DataFrame, by: list[str], assessed: str, price: str, **median) -> DataFrame:
    """Per group: sales, median, mean and weighted mean ratio, COD and PRD.

    The distances need the medians, so the ratios are read twice; they are written once, narrow.
    """
    ratios = stage(ratio_table(df, by, assessed, price), "ratios")
    median = {"staged": True, **median}
    medians = stage(grouped_median(ratios, by, "_ratio", "median_ratio", **median), "medians")
    distance = F.abs(F.col("_ratio") - F.col("median_ratio"))
    study = attach(ratios, medians, by).groupBy(*by).agg(
        *_means(), F.first("median_ratio").alias("median_ratio"), F.avg(distance).alias("_spread")
    )
    dispersion = F.when(
        F.col("median_ratio") != 0, 100 * F.col("_spread") / F.col("median_ratio")
    )
    return study.select(
        *by, "sales", "median_ratio", "mean_ratio", "weighted_mean_ratio",
        dispersion.alias("cod"), _prd(),
    )


def eligible_sales(sales: DataFrame, codes: DataFrame, code: str, lookup_code: str, flag: str) -> DataFrame:
    """Sales whose transaction (or stratum) code is flagged for ratio analysis in its lookup."""
    flagged = codes.filter(F.col(flag)).select(F.col(lookup_code).alias("_code")).distinct()
    return sales.join(flagged, F.col(code) == F.col("_code"), "left_semi")

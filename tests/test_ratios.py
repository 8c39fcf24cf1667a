import random

import pytest
from pyspark.sql import functions as F

from cadastra.operators.ratios import cod, eligible_sales, grouped_median, prd, ratio_study, sales_ratio


def study(spark, pairs, **options):
    df = spark.createDataFrame([("g", *p) for p in pairs], "g string, av int, sp int")
    return ratio_study(df, ["g"], "av", "sp", **options).first()


@pytest.mark.parametrize("options", [{}, {"strategy": "placed", "rows_per_place": 1}])
def test_study(spark, options):
    got = study(spark, [(80, 100), (100, 100), (120, 100), (50, 0), (50, None), (50, -5)], **options)
    assert got["sales"] == 3
    assert got["median_ratio"] == pytest.approx(1.0)
    assert got["cod"] == pytest.approx(13.3333, abs=1e-4)
    assert got["prd"] == pytest.approx(1.0)


def test_weighted_mean(spark):
    got = study(spark, [(80, 100), (300, 300)])
    assert got["mean_ratio"] == pytest.approx(0.9)
    assert got["weighted_mean_ratio"] == pytest.approx(0.95)
    assert got["prd"] == pytest.approx(0.947368, abs=1e-6)


def test_equal_ratios_have_no_dispersion(spark):
    df = spark.createDataFrame([(i % 3, 2 * i, i) for i in range(1, 60)], "g int, av int, sp int")
    assert all(r["cod"] == 0 for r in cod(df, ["g"], "av", "sp").collect())
    assert all(r["prd"] == pytest.approx(1) for r in prd(df, ["g"], "av", "sp").collect())


def test_ratio_needs_a_positive_price(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (1, None), (None, 2)], "v int, p int")
    got = [r[0] for r in df.select(sales_ratio(F.col("v"), F.col("p"))).collect()]
    assert got == [0.5, None, None, None]


def test_only_flagged_codes_count(spark):
    sales = spark.createDataFrame([(1, "Q"), (2, "U"), (3, "X"), (4, None)], "id int, code string")
    codes = spark.createDataFrame([("Q", True), ("Q", True), ("U", False), ("X", None)], "c string, f boolean")
    assert [r["id"] for r in eligible_sales(sales, codes, "code", "c", "f").collect()] == [1]


@pytest.mark.parametrize("kind", ["double", "bigint", "decimal(20,4)"])
@pytest.mark.parametrize("steps", [40, 4096])
def test_medians_by_refinement(spark, kind, steps):
    rnd = random.Random(8)
    data = [("even", x) for x in (1.0, 2.0, 4.0, 9.0)] + [("odd", 3.0), ("odd", 3.0), ("odd", -7.0)]
    data += [("one", 5.0)] + [(None, float(rnd.randint(-50, 50))) for _ in range(301)]
    data += [("hot", 7.0)] * 400 + [("hot", rnd.choice([-1e15, 1e-3, 8.0, 1e15, 1e17])) for _ in range(399)]
    data += [("wide", rnd.choice([-1, 1]) * 10.0 ** rnd.randint(-12, 12)) for _ in range(200)] + [("empty", None)]
    if kind == "double":
        data += [("huge", -1.7e308), ("huge", 1.7e308), ("huge", 1.0)]
    df = spark.createDataFrame(data, "g string, v double").filter("v IS NULL OR abs(v) < 1e16 OR '%s' = 'double'" % kind)
    df = df.withColumn("v", F.col("v").cast(kind))

    def medians(by, strategy):
        out = grouped_median(df, by, "v", "m", strategy=strategy, rows_per_place=1, steps=steps)
        return {r[0] if by else "": r["m"] for r in out.collect()}

    assert medians(["g"], "placed") == pytest.approx(medians(["g"], "plain"), rel=1e-12)
    assert medians([], "placed") == pytest.approx(medians([], "plain"), rel=1e-12)


def test_neighbouring_bigints_are_told_apart(spark):
    df = spark.createDataFrame([(2**60 + i,) for i in (0, 0, 1, 1, 1)], "v bigint")
    got = grouped_median(df, [], "v", "m", strategy="placed", rows_per_place=1).first()["m"]
    assert got == float(2**60 + 1)


def test_no_values_have_no_median(spark):
    df = spark.createDataFrame([("a", None)], "g string, v double")
    assert grouped_median(df, ["g"], "v", "m", strategy="placed").collect() == []
    assert grouped_median(df, [], "v", "m", strategy="placed").count() <= 1

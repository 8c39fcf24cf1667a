"""Placed scans must equal plain windows whatever the number of places."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cadastra.operators import ordered
from cadastra.operators.ordered import ordered_totals
from cadastra.operators.ratios import grouped_median
from cadastra.operators.strata import value_groups
from cadastra.shared import stage
from tests.conftest import rows


@pytest.fixture(scope="module")
def mixed(spark):
    """Few groups, NULL groups and values, negative values, ties, and a key held by a third."""
    rnd = random.Random(3)
    data = [
        (
            rnd.choice([None, "a", "b", "b", "c"]),
            rnd.choice([None, 0, 0, -5, rnd.randint(-20, 40), rnd.randint(0, 100_000)]),
            f"k{rnd.randint(0, 500):04d}" if rnd.random() < 0.95 else None,
        )
        for _ in range(2000)
    ]
    data += [("b", 7, "copy")] * 1000
    return spark.createDataFrame(
        [(*row, n) for n, row in enumerate(data)], "g string, v int, id string, n int"
    )


@pytest.mark.parametrize("rows_per_place", [20, 700, 10_000])
def test_totals_and_ranks(mixed, rows_per_place):
    plain = ordered_totals(mixed, ["g"], "v", "id", strategy="plain")
    placed = ordered_totals(mixed, ["g"], "v", "id", strategy="placed", rows_per_place=rows_per_place)
    assert placed.dtypes == plain.dtypes
    assert rows(placed) == rows(plain)


@pytest.mark.parametrize("rows_per_place", [20, 700])
def test_value_groups(mixed, rows_per_place):
    plain = value_groups(mixed, ["g"], "v", "id", "grp", outlier_share=0.001, strategy="plain")
    placed = value_groups(
        mixed, ["g"], "v", "id", "grp", outlier_share=0.001, strategy="placed",
        rows_per_place=rows_per_place,
    )
    assert rows(placed) == rows(plain)


@pytest.mark.parametrize("rows_per_place", [20, 700, 10_000])
def test_medians(mixed, rows_per_place):
    plain = grouped_median(mixed, ["g"], "v", "m", strategy="plain")
    placed = grouped_median(mixed, ["g"], "v", "m", strategy="placed", rows_per_place=rows_per_place)
    assert rows(placed) == rows(plain)


def test_median_of_even_counts(spark):
    df = spark.createDataFrame([("a", x) for x in (1.0, 2.0, 4.0, 9.0)], "g string, v double")
    placed = grouped_median(df, ["g"], "v", "m", strategy="placed", rows_per_place=1)
    assert rows(placed) == [("a", 3.0)]


@pytest.mark.parametrize("rows_per_place", [7, 60])
def test_a_key_in_many_parts(spark, rows_per_place):
    data = [("a", 5, "same")] * 100 + [("a", None, "same")] * 50 + [("a", 4, "x"), ("a", 5, "t"), (None, 5, "same")]
    data += [("b", None, None)] * 30
    df = spark.createDataFrame(data, "g string, v int, id string")
    for by in (["g"], []):
        plain = ordered_totals(df, by, "v", "id", strategy="plain")
        placed = ordered_totals(df, by, "v", "id", strategy="placed", rows_per_place=rows_per_place)
        assert rows(placed) == rows(plain)


def test_wide_decimals_and_floating_ties(spark):
    rnd = random.Random(4)
    data = [(Decimal(rnd.randint(-10**24, 10**24)).scaleb(-4), rnd.choice([1.5, float("nan"), None, -2.0])) for _ in range(300)]
    df = spark.createDataFrame(data, "v decimal(28,4), tie double").withColumn("i", F.monotonically_increasing_id())
    plain = ordered_totals(df, [], "v", "tie", strategy="plain")
    placed = ordered_totals(df, [], "v", "tie", strategy="placed", rows_per_place=40)
    assert placed.dtypes == plain.dtypes and rows(placed.drop("tie")) == rows(plain.drop("tie"))


def test_parts_take_one_exchange_of_the_rows(mixed):
    source = stage(mixed)
    placed = ordered_totals(source, ["g"], "v", "id", strategy="placed", rows_per_place=50, staged=True)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "BroadcastHashJoin" in plan
    assert max(r["n"] for r in _parts_of(source).groupBy("_part").agg(F.count("*").alias("n")).collect()) < 400


def _parts_of(source):
    return ordered._parts(source, ["g"], "v", "id", F.col("v").cast("decimal(38,0)"), 40)


def test_floating_values_are_refused(spark):
    df = spark.createDataFrame([("a", 1.0, 1)], "g string, v double, id int")
    with pytest.raises(ValueError, match="decimal"):
        ordered_totals(df, ["g"], "v", "id")


def test_no_rows(spark):
    df = spark.createDataFrame([], "g string, v int, id string")
    assert ordered_totals(df, ["g"], "v", "id").collect() == []
    assert ordered_totals(df, ["g"], "v", "id", strategy="placed").collect() == []


def test_small_parts_share_few_tasks(mixed, monkeypatch):
    monkeypatch.setattr(ordered, "FEW_TASKS", 3)
    monkeypatch.setattr(ordered, "ROWS_PER_TASK", 500)
    dealt, deal = [], ordered._parts

    def counted(*given):
        dealt.append(deal(*given))
        return dealt[-1]

    monkeypatch.setattr(ordered, "_parts", counted)
    plain = ordered_totals(mixed, ["g"], "v", "id", strategy="plain")
    placed = ordered_totals(mixed, ["g"], "v", "id", strategy="placed", rows_per_place=20)
    assert rows(placed) == rows(plain)
    sizes = dealt[0].groupBy("_part").agg(F.count("*").alias("n")).collect()
    assert len({r["_part"] >> 32 for r in sizes}) <= 6 and len(sizes) >= 150 and max(r["n"] for r in sizes) == 20


def test_wide_rows_are_cut_by_their_bytes(mixed, monkeypatch):
    batches = stage(mixed).coalesce(1).toArrow().to_batches(max_chunksize=500)
    cut = list(ordered._cut(iter(batches), 200_000, batches[0].nbytes))
    assert len(cut) > 2 and sum(part.num_rows for part in cut) == mixed.count()
    assert max(part.num_rows for part in cut) <= 1000
    monkeypatch.setattr(ordered, "PLACE_BYTES", 1)
    plain = ordered_totals(mixed, [], "v", "id", strategy="plain")
    placed = ordered_totals(mixed, [], "v", "id", strategy="placed")
    assert rows(placed) == rows(plain)

"""Clustering features: attributes with summed areas, constants for gaps, one-hot, scaling."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING = "None"


def feature_table(
    parcels: DataFrame, buildings: DataFrame, key: str, attributes: dict[str, Column], area: str,
    out: str, fill: dict[str, object],
) -> DataFrame:
    """One row per key and attributes, with the area summed over the key's buildings.

    Repeated parcels are counted and areas are summed before the join, so however often a key
    occurs on either side, little of it is shuffled. ``fill`` replaces missing attributes.
    """
    areas = buildings.groupBy(key).agg(F.sum(area).alias("_area"))
    described = parcels.select(key, *[value.alias(name) for name, value in attributes.items()])
    counted = described.groupBy(key, *attributes).agg(F.count(F.lit(1)).alias("_copies"))
    total = F.coalesce(F.col("_area") * F.col("_copies"), F.lit(0)).alias(out)
    return counted.join(areas, key, "left").select(key, *attributes, total).fillna(fill)


def _category(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(MISSING))


def categories(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """The sorted categories of each column, as many as there are."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), _category(c).alias("value")) for c in columns])
    )
    found = df.select(pairs.alias("p")).select("p.*").distinct().collect()
    return {c: sorted(row["value"] for row in found if row["column"] == c) for c in columns}


def one_hot(
    df: DataFrame, columns: list[str], known: dict[str, list[str]] | None = None
) -> tuple[DataFrame, list[str]]:
    """Add a 0/1 column per category but the first of each column; also return their names.

    For a table to read. Clustering uses :func:`feature_vectors`, which stores no zeros.
    """
    known = known or categories(df, columns)
    flags = {
        f"{name}_{value}": (_category(name) == F.lit(value)).cast("int")
        for name in columns
        for value in known[name][1:]
    }
    return df.select("*", *[flag.alias(name) for name, flag in flags.items()]), list(flags)


def feature_vectors(
    df: DataFrame, keep: list[str], numbers: list[str], categories: list[str]
) -> DataFrame:
    """The kept columns and a sparse vector ``features``: numbers, and a flag per category but the first.

    Every feature is divided by its population deviation; constant ones become 0. They are not centred:
    distances do not change when a feature is shifted, and a row stores its numbers and one flag per
    column however many categories there are.
    """
    plain = df.select(
        *keep, *[F.col(f"`{name}`").cast("double").alias(f"n{at}") for at, name in enumerate(numbers)],
        *[_category(f"`{name}`").alias(f"c{at}") for at, name in enumerate(categories)],
    )
    inputs = [f"n{at}" for at in range(len(numbers))]
    stages = []
    # Descending, so that the encoder, which leaves out the last, leaves out the first category.
    for at in range(len(categories)):
        labels = StringIndexer(
            inputCol=f"c{at}", outputCol=f"i{at}", stringOrderType="alphabetDesc"
        ).fit(plain)
        if len(labels.labels) > 1:
            stages += [labels, OneHotEncoder(inputCols=[f"i{at}"], outputCols=[f"h{at}"])]
            inputs.append(f"h{at}")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    encoded = Pipeline(stages=stages).fit(plain).transform(plain).select(*keep, "features")
    summary = encoded.agg(
        Summarizer.metrics("variance", "count").summary(F.col("features")).alias("s")
    ).select("s.variance", "s.count").first()
    if not summary or not summary["count"]:
        return encoded
    rows = summary["count"]
    population = [v * (rows - 1) / rows for v in summary["variance"].toArray()]
    scale = Vectors.dense([1 / v**0.5 if v > 0 else 0.0 for v in population])
    scaled = ElementwiseProduct(scalingVec=scale, inputCol="features", outputCol="_scaled")
    return scaled.transform(encoded).select(*keep, F.col("_scaled").alias("features"))


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Shift and scale columns to mean 0 and population deviation 1; constant columns become 0."""
    measures = [F.avg(f"`{c}`") for c in columns] + [F.stddev_pop(f"`{c}`") for c in columns]
    stats = df.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures)]).first()
    scaled = {}
    for number, name in enumerate(columns):
        mean, deviation = stats[number], stats[number + len(columns)]
        value = (F.col(f"`{name}`") - F.lit(mean)) / F.lit(deviation) if deviation else F.lit(0.0)
        scaled[name] = value
    return df.select(
        *[scaled[c].alias(c) if c in scaled else F.col(f"`{c}`") for c in df.columns]
    )

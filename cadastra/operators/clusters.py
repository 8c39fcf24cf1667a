"""k-means over standardized features, with the number of clusters chosen at the elbow."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.operators.lloyd import KMeansCentres, fit_many

K_RANGE = range(2, 11)
SEED = 42


def assemble(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """The kept columns and the vector ``features``."""
    # The assembler takes no names with dots, so columns go in under plain ones.
    plain = {f"f{number}": name for number, name in enumerate(columns)}
    renamed = df.select(
        *keep, *[F.col(f"`{name}`").cast("double").alias(p) for p, name in plain.items()]
    )
    return VectorAssembler(inputCols=list(plain), outputCol="features").transform(renamed).select(
        *keep, "features"
    )


def kmeans_sweep(
    vectors: DataFrame, ks=K_RANGE, seed: int = SEED
) -> tuple[DataFrame, dict[int, KMeansCentres]]:
    """Fit every k over the same rows, all in the same scans: a table (k, wcss), and the models."""
    models = fit_many(vectors, ks, seed)
    rows = [(k, model.cost) for k, model in models.items()]
    return vectors.sparkSession.createDataFrame(rows, "k int, wcss double"), models


def elbow(table: DataFrame, k: str = "k", wcss: str = "wcss") -> DataFrame:
    """Add each point's distance to the chord between the first and the last point."""
    x, y = F.col(k), F.col(wcss)
    ends = table.agg(
        F.struct(
            F.min(x).alias("x1"), F.min_by(y, x).alias("y1"),
            F.max(x).alias("x2"), F.max_by(y, x).alias("y2"),
        )
    ).scalar()
    chord = F.col("_ends")
    dx, dy = chord["x2"] - chord["x1"], chord["y2"] - chord["y1"]
    area = F.abs(dx * (chord["y1"] - y) - (chord["x1"] - x) * dy)
    return table.withColumn("_ends", ends).withColumn(
        "distance", area / F.sqrt(dx * dx + dy * dy)
    ).drop("_ends")


def choose_k(table: DataFrame, k: str = "k", wcss: str = "wcss") -> int:
    """The k farthest from the chord, the smallest of equals."""
    return elbow(table, k, wcss).orderBy(F.desc("distance"), k).first()[k]


def assign_clusters(model: KMeansCentres, vectors: DataFrame, key: str) -> DataFrame:
    """Key and label ``Cluster 1`` to ``Cluster k``."""
    label = F.concat(F.lit("Cluster "), (F.col("prediction") + 1).cast("string"))
    return model.transform(vectors).select(key, label.alias("cluster_label"))

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cadastra.checks.queries import QUERIES
from cadastra.operators import lloyd
from cadastra.operators.clusters import choose_k, elbow, kmeans_sweep
from cadastra.operators.features import categories, feature_table, feature_vectors, one_hot, standardize
from cadastra.plans.build import cluster_parcels, parcel_features, vectors_of
from tests.conftest import rows


def sweep(spark, wcss):
    return spark.createDataFrame(list(enumerate(map(float, wcss), 2)), "k int, wcss double")


def test_elbow(spark):
    assert choose_k(sweep(spark, [100, 60, 30, 25, 21, 18, 15, 12, 10])) == 4
    straight = sweep(spark, [90, 80, 70, 60, 50, 40, 30, 20, 10])
    assert choose_k(straight) == 2
    assert elbow(straight).agg(F.max("distance")).first()[0] == 0


def test_one_hot_drops_the_first_category(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, "a")], "i int, t string")
    encoded, flags = one_hot(df, ["t"])
    assert flags == ["t_b", "t_c"]
    assert rows(encoded.drop("t")) == [(1, 1, 0), (2, 0, 0), (3, 0, 1), (4, 0, 0)]


def test_missing_values_are_a_category(spark):
    df = spark.createDataFrame([("b",), (None,)], "t string")
    assert categories(df, ["t"]) == {"t": ["None", "b"]}


def test_thousands_of_categories_store_one_flag_a_row(spark):
    df = spark.range(3_000).selectExpr("id", "cast(id % 7 as double) AS n", "concat('c', id) AS t")
    vectors = feature_vectors(df, ["id"], ["n"], ["t"]).collect()
    assert {len(row["features"]) for row in vectors} == {3_000}
    assert max(len(row["features"].indices) for row in vectors) <= 2
    assert len(categories(df, ["t"])["t"]) == 3_000


def test_vectors_are_the_standardized_columns_unshifted(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "b", 5), (2, 3.0, "a", 5), (3, 8.0, None, 5)], "i int, a double, t string, same int")
    found = {row["i"]: row["features"].toArray() for row in feature_vectors(df, ["i"], ["a", "same"], ["t"]).collect()}
    encoded, flags = one_hot(df, ["t"])
    dense = {row["i"]: [row[c] for c in ("a", "same", *flags)] for row in
             standardize(encoded, ["a", "same", *flags]).collect()}
    for i, j in ((1, 2), (2, 3), (1, 3)):
        apart = sum((x - y) ** 2 for x, y in zip(found[i], found[j]))
        assert apart == pytest.approx(sum((x - y) ** 2 for x, y in zip(dense[i], dense[j])))


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 5), (3.0, 5)], "a double, b int")
    assert rows(standardize(df, ["a", "b"])) == [(-1.0, 0.0), (1.0, 0.0)]


def test_features_of_repeated_and_missing_parcels(spark):
    parcels = spark.createDataFrame(
        [("p1", 10, "m", None, "0100"), ("p1", 10, "m", None, "0100"), ("p2", None, None, "good", None)],
        "parcel_id string, total_value int, market_area_code string, impvmt_quality string, dor_use_code string",
    )
    buildings = spark.createDataFrame([("p1", 2.0), ("p1", 3.0), ("p9", 7.0)], "parcel_id string, total_under_roof double")
    got = parcel_features(parcels, buildings).select(
        "parcel_id", "total_value", "market_area_code", "impvmt_quality", "dor_uc_2", "total_under_roof")
    assert rows(got) == [
        ("p1", 10, "m", "Vacant/None", "01", 10.0), ("p2", 0, "Unknown", "good", None, 0.0)]


@pytest.fixture(scope="module")
def blobs(spark):
    data = [
        (f"p{c}-{i}", 100.0 * c + i % 5, 50.0 * c + i % 3, f"area{c}") for c in range(4) for i in range(30)
    ]
    return spark.createDataFrame(data, "id string, a double, b double, area string")


def test_clusters_have_the_right_properties(spark, blobs):
    labels, table = cluster_parcels(blobs, "id", ["a", "b"], ["area"], ks=range(2, 7))
    assert labels.count() == blobs.count() == labels.select("id").distinct().count()
    k = choose_k(table)
    names = sorted(r[0] for r in labels.select("cluster_label").distinct().collect())
    assert names == [f"Cluster {i}" for i in range(1, k + 1)]
    costs = [r["wcss"] for r in table.orderBy("k").collect()]
    assert all(b <= a * 1.05 + 1e-9 for a, b in zip(costs, costs[1:]))


def test_inertia_equals_a_recomputation(spark, blobs):
    vectors = vectors_of(blobs, "id", ["a", "b"], ["area"])
    table, models = kmeans_sweep(vectors, [4])
    centres = models[4].clusterCenters()
    total = sum(
        min(((row["features"].toArray() - c) ** 2).sum() for c in centres) for row in vectors.collect()
    )
    assert table.first()["wcss"] == pytest.approx(total, rel=1e-6, abs=1e-6)


def test_all_k_share_their_scans(spark, blobs, monkeypatch):
    scans = []
    whole = lloyd._scan_all
    monkeypatch.setattr(lloyd, "_scan_all", lambda points, models: scans.append(set(models)) or whole(points, models))
    vectors = vectors_of(blobs, "id", ["a", "b"], ["area"])
    models = lloyd.fit_many(vectors, range(2, 8), 42, sample_rows=20)
    alone = []
    for k in range(2, 8):
        before = len(scans)
        assert np.allclose(lloyd.fit_many(vectors, [k], 42, sample_rows=20)[k].cost, models[k].cost, rtol=0.5)
        alone.append(len(scans) - before)
    assert scans[0] == set(range(2, 8)) and len(scans) - sum(alone) <= max(alone) + 5


def test_centres_are_the_means_of_their_rows(spark, blobs):
    vectors = vectors_of(blobs, "id", ["a", "b"], ["area"])
    model = kmeans_sweep(vectors, [4])[1][4]
    found = {}
    for row in model.transform(vectors).collect():
        found.setdefault(row["prediction"], []).append(row["features"].toArray())
    assert sorted(map(len, found.values())) == [30] * 4
    for number, own in found.items():
        assert np.allclose(model.clusterCenters()[number], np.mean(own, axis=0), atol=1e-3)


def test_dense_vectors_few_rows_and_none(spark):
    rows = [(Vectors.dense([1.0, 0.0]),), (Vectors.sparse(2, [1], [5.0]),), (Vectors.dense([1.0, 0.0]),), (Vectors.sparse(2, [], []),)]
    vectors = spark.createDataFrame(rows, ["features"])
    models = lloyd.fit_many(vectors, [2, 3, 5], 1)
    assert len(models[5].clusterCenters()) == 3 and models[3].cost == pytest.approx(0, abs=1e-9)
    assert models[5].transform(vectors).select("prediction").distinct().count() == 3
    assert lloyd.fit_many(vectors.limit(0), [2], 1) == {}


def test_repeated_parcels_are_counted_before_they_are_shuffled(spark):
    parcels = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    lines = spark.range(500).select((F.col("id") % 90).alias("k"), F.col("id").alias("area"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = feature_table(parcels, lines, "k", {"v": F.col("v")}, "area", "area", {})
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("partial_count(1)") == plan.count("partial_sum") == 1


@pytest.mark.parametrize("name", ["kmeans_properties", "kmeans_assign"])
def test_labels_of_every_row_are_not_broadcast(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan

"""Joins, audits, warehouse, whole builds, and the shape of the physical plans."""

import os
import pathlib
import threading
import time
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cadastra.checks import queries as checked, standins
from cadastra.checks.queries import RULES, dim_build
from cadastra.operators.audit import assert_grain, duplicate_keys, fanout_audit, require_columns
from cadastra.operators.joins import attach, hot_keys, left_enrich
from cadastra.operators.ordered import ordered_totals
from cadastra.operators.parcels import recent_totals
from cadastra.plans.build import (
    build_warehouse, crs_of, project_coordinates, publish_clusters, reproject_dimension, with_crs,
)
from cadastra.plans.parcels import DIM_COLUMNS, StudyRules, build_dim_parcels, parcel_base
from cadastra.plans.warehouse import Warehouse, decode_table
from cadastra.shared import scratch_path, scratch_scope, shared_dir, stage
from cadastra.sources.contracts import STAGING, StagingSpec
from cadastra.sources.delimited import project_typed, scan_delimited
from tests.conftest import rows

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    """The physical plan, with its filters unabbreviated."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "1000")
    return df._jdf.queryExecution().executedPlan().toString()


# --- joins and audits --------------------------------------------------------------------------

def test_hot_keys_on_the_right_change_nothing(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k int, l string")
    right = spark.createDataFrame([(1, i) for i in range(40)] + [(2, 99), (None, 5)], "k int, r int")
    assert rows(hot_keys(right, "k", hot_rows=10, fraction=1.0)) == [(1,)]
    plain = left.join(right, "k", "left")
    assert rows(left_enrich(left, right, "k", hot_rows=10, fraction=1.0)) == rows(plain)
    assert rows(left_enrich(left, right, "k")) == rows(plain)


def test_null_groups_are_attached(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, l string")
    right = spark.createDataFrame([(1, 10), (None, 20)], "k int, r int")
    assert rows(attach(left, right, ["k"])) == rows(
        spark.createDataFrame([(1, "a", 10), (None, "b", 20), (2, "c", None)], "k int, l string, r int"))


def test_fanout(spark):
    parcels = spark.createDataFrame([("a",), ("b",), ("c",)], "p string")
    shapes = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "p string, s int")
    out = parcels.join(shapes, "p", "left")
    assert rows(fanout_audit(parcels, out, "t")) == [("t", 3, 4, 1, 33.33)]
    assert rows(duplicate_keys(out, ["p"])) == [("a", 2)]
    assert_grain(parcels, ["p"])
    with pytest.raises(ValueError, match="not unique"):
        assert_grain(out, ["p"])
    with pytest.raises(ValueError, match="nope"):
        require_columns(out, ["p", "nope"])


# --- scratch and warehouse ---------------------------------------------------------------------

def test_staged_tables_go_to_the_shared_folder_and_away(spark, tmp_path):
    with scratch_scope(spark):
        df = stage(spark.range(5).toDF("n"))
        path = df.inputFiles()[0]
        assert shared_dir(spark) in path
        assert df.count() == 5
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_warehouse_replaces_a_table_it_reads(spark):
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    assert warehouse.publish("t", spark.range(10).toDF("n")) == 10
    assert warehouse.replace("t", warehouse.read("t").filter("n < 4")) == 4
    assert warehouse.read("t").count() == 4
    assert "zstd" in warehouse.read("t").inputFiles()[0]
    assert "/lookups/" in warehouse.path("x_lup")


def test_projection_happens_once(spark):
    feet = spark.createDataFrame([(656166.667, 1205461.647)], "longitude double, latitude double")
    degrees = project_coordinates(with_crs(feet, "EPSG:2882"))
    assert crs_of(degrees) == "EPSG:4326"
    with pytest.raises(ValueError, match="already"):
        project_coordinates(degrees)
    with pytest.raises(ValueError, match="latitude"):
        project_coordinates(feet.drop("latitude"))


# --- builds ------------------------------------------------------------------------------------


def staging(spark, name, data):
    columns = STAGING[name].columns
    schema = ", ".join(f"{out} {kind}" for _, out, kind in columns)
    return spark.createDataFrame([tuple(row.get(out) for _, out, _ in columns) for row in data], schema)


def test_dimension_of_hand_made_parcels(spark):
    def parcel(key, use, value, **more):
        return {
            "parcel_id": key, "dor_use_code": use, "total_value": value, "homestead": Decimal(0),
            "assessed_value": Decimal(value), "base_tax_value": Decimal(value), **more,
        }

    parcels = staging(spark, "stg_parcel", [
        parcel("232728000000012345", "0100", 900, last_insp_date=datetime(2020, 1, 1)),
        parcel("232728000000012346", "0100", 60),
        parcel("232728000000012347", "0800", 10),
        parcel("232728000000012348", "0900", 5),
        parcel("232728000000012349", "0100", 40),
    ])
    roll = staging(spark, "stg_nal", [
        {"parcel_id": "232728000000012345", "last_inspect_date": 126, "market_area_code": "07"},
        {"parcel_id": "232728000000012346", "last_inspect_date": 1299},
        {"parcel_id": "232728000000012347", "last_inspect_date": 0},
    ])
    shapes = spark.createDataFrame(
        [("232728000000012345", 1.0, 2.0), ("232728000000012347", 3.0, 4.0), ("232728000000012347", 5.0, 6.0)],
        "parcel_id string, longitude double, latitude double")
    permits = staging(spark, "stg_permit", [
        {"parcel_id": "232728000000012349", "final_insp_date": datetime(2026, 5, 1), "est_value": 30},
        {"parcel_id": "232728000000012349", "final_insp_date": datetime(2026, 6, 1), "est_value": 11},
        {"parcel_id": "232728000000012346", "final_insp_date": datetime(2025, 6, 1), "est_value": 1000},
        {"parcel_id": "232728000000012348", "final_insp_date": datetime(2026, 8, 7), "est_value": None},
    ])
    dim = build_dim_parcels(parcels, roll, shapes, permits)
    assert tuple(dim.columns) == DIM_COLUMNS and len(DIM_COLUMNS) == 50
    got = rows(dim.select(
        F.substring("parcel_id", 16, 3), "market_area_code", "latitude", "last_insp_date",
        "my_basic_stratum", "my_active_stratum", "has_recent_final_inspect",
        "recent_permit_total_value", "my_group_number"))
    assert got == [
        ("345", "07", 2.0, datetime(2020, 1, 1), 1, 1, False, 0.0, 6),
        ("346", None, None, datetime(1999, 12, 1), 1, 1, False, 0.0, 4),
        ("347", None, 4.0, None, 2, 8, False, 0.0, 6),
        ("347", None, 6.0, None, 2, 8, False, 0.0, 6),
        ("348", None, None, None, 13, 13, True, 0.0, 6),
        ("349", None, None, None, 11, 11, True, 41.0, 6),
    ]


def test_hot_and_missing_parcel_keys_are_joined_apart(spark):
    parcels = standins.parcels(spark, SF_DIR)
    keys = F.when(F.col("on_reconcile") == "P", F.lit(None)).when(
        F.col("on_reconcile") == "F", F.lpad(F.lit("7"), 18, "0")).otherwise(F.col("parcel_id"))
    parcels = parcels.withColumn("parcel_id", keys)
    inputs = [
        standins.roll(spark, SF_DIR), standins.centroids_in_feet(spark, SF_DIR), standins.permits(spark, SF_DIR)]
    assert rows(hot_keys(parcels, "parcel_id", 100, 1.0)) == [("7".rjust(18, "0"),), (None,)]
    plain = parcel_base(parcels, *inputs, StudyRules(as_of="2001-08-01"))
    apart = parcel_base(parcels, *inputs, StudyRules(as_of="2001-08-01", hot_rows=100, hot_sample=1.0))
    assert "Union" in plan(apart) and "Union" not in plan(plain)
    assert rows(apart.select(sorted(apart.columns))) == rows(plain.select(sorted(plain.columns)))


DICTIONARY_TYPES = {
    "parcel_id": "string", "latitude": "double", "longitude": "double",
    "nbrhd_code": "decimal(10,2)", "homestead": "decimal(10,2)", "total_acreage": "decimal(12,4)",
    "year_created": "int", "total_value": "int", "jv_dor": "double", "asmnt_year": "int",
    "assessed_value": "decimal(10,2)", "base_tax_value": "decimal(10,2)", "basic_stratum": "string",
    "disaster_year": "int", "last_insp_date": "timestamp_ntz", "my_basic_stratum": "int",
    "my_active_stratum": "int", "has_recent_final_inspect": "boolean",
    "recent_permit_total_value": "double", "my_group_number": "int",
}


def test_raw_files_to_clusters(spark):
    raw = scratch_path(spark, "raw")
    standins.write_raw_files(spark, SF_DIR, raw)
    warehouse, audit = build_warehouse(spark, raw, scratch_path(spark, "warehouse"), RULES)
    kept = {r["table_name"]: (r["kept_rows"], r["kept_percent"]) for r in audit.collect()}
    assert len(kept) == 8 + 19 + 2
    assert kept["fact_permit"] == (6000, 100.0)

    dim = warehouse.read("dim_parcels")
    assert {c: t for c, t in dim.dtypes if c in DICTIONARY_TYPES} == DICTIONARY_TYPES
    assert crs_of(dim) == "EPSG:2882"
    parcels = dim.count()
    assert reproject_dimension(warehouse) == parcels
    assert reproject_dimension(warehouse) == 0
    assert warehouse.read("dim_parcels").agg(F.min("longitude")).first()[0] > -83

    direct = dim_build(spark, SF_DIR).select("parcel_id", "my_active_stratum", "my_group_number")
    assert rows(warehouse.read("dim_parcels").select(direct.columns)) == rows(direct)

    lookups = {name: warehouse.read(name) for name in kept if name.endswith("_lup")}
    for name in ("dim_parcels", "fact_bldg", "fact_misc", "fact_permit", "fact_sales"):
        table = warehouse.read(name)
        assert decode_table(name, table, lookups).count() == table.count()

    assert all(row["seconds"] > 0 for row in audit.collect())

    sweep = publish_clusters(warehouse, ks=range(2, 5))
    assert [r["k"] for r in sweep.orderBy("k").collect()] == [2, 3, 4]
    clusters = warehouse.read("dim_parcel_clusters")
    assert clusters.columns == ["parcel_id", "cluster_label"]
    assert clusters.count() == parcels


# --- plans -------------------------------------------------------------------------------------

@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_date_window_and_columns_reach_the_scan(spark):
    lines = standins.table(spark, SF_DIR, "lineitem")
    text = plan(recent_totals(lines, "l_orderkey", "l_shipdate", "l_quantity", "2001-08-01"))
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThanOrEqual(l_shipdate" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in text


def test_placed_scan_has_no_one_task_exchange_and_no_window_over_a_whole_group(spark):
    orders = standins.table(spark, SF_DIR, "orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    out = ordered_totals(
        orders, ["o_orderpriority"], "price", "o_orderkey", strategy="placed", rows_per_place=50)
    text = plan(out)
    # The rows went through their one exchange when the parts were written; what is left joins their starts.
    assert "SinglePartition" not in text and "Window" not in text and "hashpartitioning" not in text
    assert "BroadcastHashJoin" in text


def test_placed_scan_is_right_when_its_tables_are_not_broadcast(spark, no_broadcast):
    orders = standins.table(spark, SF_DIR, "orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    by = (["o_orderpriority"], "price", "o_orderkey")
    placed = ordered_totals(orders, *by, strategy="placed", rows_per_place=50)
    assert "BroadcastHashJoin" not in plan(placed)
    assert rows(placed) == rows(ordered_totals(orders, *by, strategy="plain"))


def test_parcel_joins_shuffle_each_input_once(spark, no_broadcast):
    inputs = [
        stage(df) for df in (
            standins.parcels(spark, SF_DIR), standins.roll(spark, SF_DIR),
            standins.centroids_in_feet(spark, SF_DIR), standins.permits(spark, SF_DIR))
    ]
    text = plan(parcel_base(*inputs, StudyRules(as_of="2001-08-01")))
    assert text.count("Exchange hashpartitioning(parcel_id") == 4


def test_a_failed_rename_keeps_the_old_table(spark, monkeypatch):
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.publish("t", spark.range(10).toDF("n"))
    moves, move = [], Warehouse._move

    def failing(self, source, target):
        moves.append((source, target))
        return False if len(moves) == 2 else move(self, source, target)

    monkeypatch.setattr(Warehouse, "_move", failing)
    with pytest.raises(OSError, match="stays at"):
        warehouse.replace("t", spark.range(3).toDF("n"))
    assert len(moves) == 3 and warehouse.read("t").count() == 10


class _Bare:
    """A session of an installation whose defaults name no shared folder."""

    def __init__(self, spark, master):
        self.conf, self.sparkContext = self, type("Context", (), {"master": master})()
        self.session, self.made = spark, {}

    def get(self, key, default=None):
        return default if key == "spark.checkpoint.dir" else self.session.conf.get(key, default)

    def set(self, key, value):
        self.made[key] = value
        self.session.conf.set(key, value)


def test_shared_folder_without_a_setting(spark):
    bare = _Bare(spark, "local[2]")
    try:
        folder = shared_dir(bare)
        assert folder == shared_dir(bare) == bare.made["cadastra.scratch.dir"]
    finally:
        spark.conf.unset("cadastra.scratch.dir")
    with pytest.raises(ValueError, match="cadastra.scratch.dir"):
        shared_dir(_Bare(spark, "spark://elsewhere:7077"))


def test_values_are_attached_without_keys(spark):
    left, one = spark.range(3).toDF("n"), spark.createDataFrame([(7, "x")], "a int, b string")
    assert rows(attach(left, one, [])) == [(0, 7, "x"), (1, 7, "x"), (2, 7, "x")]
    assert rows(attach(left, one.limit(0), [])) == [(0, None, None), (1, None, None), (2, None, None)]


def test_raw_text_of_facts_is_packed_and_goes_once_published(spark, tmp_path, monkeypatch):
    spec, packed = STAGING["stg_land"], tmp_path / "land.txt"
    made = standins.facts(spark, SF_DIR, spec)
    monkeypatch.setattr(standins, "PACKED_ROWS", 1000)
    standins.write_raw(made, spec, str(packed), "|")
    files = list(packed.glob("part-*"))
    assert len(files) >= made.count() / 1000 and all(f.suffix == ".lz4" for f in files)
    read = project_typed(scan_delimited(spark, str(packed), "|").kept, spec.columns)
    assert rows(read) == rows(made)

    paths, path = [], checked.scratch_path
    monkeypatch.setattr(checked, "scratch_path", lambda *given: paths.append(path(*given)) or paths[-1])
    assert checked.q_warehouse_facts(spark, SF_DIR).count() == 80
    raw = [p for p in paths if "/raw-" in p]
    assert len(raw) == len(standins.FACTS) and not any(os.path.exists(p) for p in raw)


def test_raw_files_of_the_build_go_once_published(spark, monkeypatch):
    """At no time more raw inputs than tables are read at once, none while the dimension is made."""
    paths, seen, path, replace = [], {}, checked.scratch_path, checked.Warehouse.replace

    def raw_files():
        (raw,) = [p for p in paths if "/raw-" in p]
        return {file.parent for kind in ("part-*", "*.shp") for file in pathlib.Path(raw).rglob(kind)}

    def spied(self, name, df, partition_by=None):
        seen[name] = {p.name for p in raw_files()}
        return replace(self, name, df, partition_by)

    monkeypatch.setattr(checked, "scratch_path", lambda *given: paths.append(path(*given)) or paths[-1])
    monkeypatch.setattr(checked.Warehouse, "replace", spied)
    assert checked.q_warehouse_build(spark, SF_DIR).count() == 1500
    assert all(1 <= len(inputs) <= 4 for name, inputs in seen.items() if name != "dim_parcels")
    large = {spec.file.replace("*", "roll") for spec in STAGING.values()}
    assert all(len(inputs & large) <= 2 for inputs in seen.values())
    assert seen["stg_gis"] == {"parcel"} and seen["dim_parcels"] == set() == raw_files()


def test_raw_files_go_when_their_table_fails(spark, monkeypatch):
    paths, path = [], checked.scratch_path
    monkeypatch.setattr(checked, "scratch_path", lambda *given: paths.append(path(*given)) or paths[-1])

    def refused(self, name, df, partition_by=None):
        raise OSError("no room")

    monkeypatch.setattr(checked.Warehouse, "replace", refused)
    with pytest.raises(OSError, match="no room"):
        checked.q_warehouse_build(spark, SF_DIR)
    assert not [p for raw in paths if "/raw-" in raw for p in pathlib.Path(raw).rglob("*") if p.is_file()]


def test_two_facts_are_made_at_a_time(spark, monkeypatch):
    """One alone leaves cores idle while its last tasks end."""
    running, most, lock = [], [], threading.Lock()

    def spied(self, name, df, partition_by=None):
        with lock:
            running.append(name)
            most.append(len(running))
        time.sleep(0.5)
        try:
            return publish(self, name, df, partition_by)
        finally:
            running.remove(name)

    publish = Warehouse.publish
    monkeypatch.setattr(Warehouse, "publish", spied)
    assert checked.q_warehouse_facts(spark, SF_DIR).count() == 80
    assert len(most) == 6 and max(most) == 2


def test_a_fact_is_profiled_by_its_values(spark):
    """No decimal is made to round a number, and no date is told before the ends are known; the rows stay the same."""
    numbers = [0.0, -0.0, 0.005, -0.005, 1.005, 2.675, -2.675, 0.0049999999999999994, 45035996273704.965, 123456.785, -1e15, None]
    held = spark.createDataFrame(
        [(f"p{at}", at, number, Decimal(at).scaleb(-2), datetime(2024, 1, 1 + at)) for at, number in enumerate(numbers)]
        + [(None, None, None, None, None)], "parcel_id string, n int, x double, d decimal(12,2), t timestamp_ntz")
    spec = StagingSpec("stg_made", "made.txt", tuple(
        (name, name, "timestamp_ntz" if name == "t" else kind) for name, kind in held.dtypes))
    made = checked._fact_profile(held, "fact_made", spec)
    texts = F.concat_ws(
        "|", "parcel_id", *[F.round(F.col(c).cast("double") * 100).cast("long").cast("string") for c in "nxd"],
        F.date_format("t", "yyyy-MM-dd"))
    digest = held.agg(F.sum(F.conv(F.substring(F.md5(texts), 1, 8), 16, 10).cast("long"))).first()[0]
    assert rows(made) == sorted([
        ("fact_made", "parcel_id", 12, None, None, "p0", "p9"), ("fact_made", "n", 12, 0.0, 11.0, None, None),
        ("fact_made", "x", 11, -1e15, 45035996273704.965, None, None), ("fact_made", "d", 12, 0.0, 0.11, None, None),
        ("fact_made", "t", 12, None, None, "2024-01-01", "2024-01-12"),
        ("fact_made", "whole rows", 13, None, None, str(digest), None)], key=str)
    shown = plan(made)
    assert "round(" not in shown and "partial_min(date_format" not in shown

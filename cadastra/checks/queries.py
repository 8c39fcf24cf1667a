"""Every operator run over the given tables, one query per operator."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext
from functools import reduce
from threading import BoundedSemaphore

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.checks import standins
from cadastra.checks.standins import money, table
from cadastra.functions.casts import parse_ts
from cadastra.functions.geometry import ring_centroid
from cadastra.functions.stateplane import to_degrees
from cadastra.operators.audit import duplicate_keys, fanout_audit, table_profile
from cadastra.operators.clusters import assign_clusters, choose_k, elbow, kmeans_sweep
from cadastra.operators.features import feature_table, feature_vectors, one_hot, standardize
from cadastra.operators.joins import left_enrich
from cadastra.operators.ordered import ordered_totals
from cadastra.operators.parcels import key_decompose, last_inspection, recent_activity
from cadastra.operators.ratios import cod, eligible_sales, prd, ratio_study, sales_ratio
from cadastra.operators.strata import (
    basic_stratum, cumulative_share, stratum_collapse, value_groups,
)
from cadastra.plans.build import (
    CLUSTER_CATEGORIES, CLUSTER_NUMBERS, Audit, build_warehouse, cluster_parcels, ingest, parcel_features,
    project_coordinates, publish_clusters, reproject_dimension, vectors_of, with_crs,
)
from cadastra.plans.parcels import StudyRules, build_dim_parcels
from cadastra.plans.versions import RunLedger, VersionedWarehouse
from cadastra.plans.warehouse import Warehouse, decode, decode_table
from cadastra.shared import remove_path, scratch_path, scratch_scope, stage
from cadastra.sources.contracts import CODE_MAP, LOOKUPS, STAGING, LookupSpec
from cadastra.sources.delimited import (
    DelimitedScan, delimiter_by_names, project_typed, scan_delimited,
)
from cadastra.sources.lookups import load_lookup
from cadastra.sources.polygons import centroids, read_polygons
from cadastra.sources.sniff import sniff_types

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-08-01"
# No single order holds 15% of a stratum's value, so the outlier share is set where some do.
RULES = StudyRules(as_of=AS_OF, outlier_share=0.0005)
# Places small enough that the given tables are cut into many.
PLACED = {"strategy": "placed", "rows_per_place": 2_000}


def _doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines return the same type."""
    return df.select(*[
        F.col(f"`{name}`").cast("double").alias(name) if kind.startswith("decimal") else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ])


def _rounded(column: str, digits: int = 6) -> Column:
    return F.round(F.col(column), digits).alias(column)


# --- sources -----------------------------------------------------------------------------------

_CUSTOMER_COLUMNS = (
    ("C_CUSTKEY", "c_custkey", "int"),
    ("C_NAME", "c_name", "string"),
    ("C_NATIONKEY", "c_nationkey", "int"),
    ("C_ACCTBAL", "c_acctbal", "decimal(18,2)"),
    ("C_MKTSEGMENT", "c_mktsegment", "string"),
)


def _customer_scan(spark: SparkSession, sf_dir: str) -> DelimitedScan:
    """Customers as quoted lines, some with a surplus field, and a short line per negative balance."""
    customer = table(spark, sf_dir, "customer").withColumn("bal", money("c_acctbal"))
    name = F.concat(F.lit('"'), F.replace("c_name", F.lit("#"), F.lit(", no ")), F.lit('"'))
    good = F.concat_ws(",", "c_custkey", name, "c_nationkey", "bal", "c_mktsegment")
    line = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(good, F.lit(",surplus"))).otherwise(good)
    short = customer.filter("c_acctbal < 0").select(F.concat_ws(",", "c_custkey", name).alias("line"))
    path = scratch_path(spark, "customers")
    header = ",".join(raw for raw, _, _ in _CUSTOMER_COLUMNS)
    standins.write_lines(customer.select(line.alias("line")).unionByName(short), header, path)
    return scan_delimited(spark, path)


def q_scan_delimited(spark, sf_dir):
    scan = _customer_scan(spark, sf_dir)
    return _doubles(project_typed(scan.kept, _CUSTOMER_COLUMNS))


def q_scan_line_breaks(spark, sf_dir):
    """Customers in one file of about 20 splits, with delimiters, quotes and line breaks inside values."""
    customer = table(spark, sf_dir, "customer")
    note = F.concat("c_mktsegment", F.lit("\n"), F.replace("c_name", F.lit("#"), F.lit(' ""no"",\n\n')))
    noted = F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")).otherwise(F.concat(F.lit('"'), note, F.lit('"')))
    path = scratch_path(spark, "notes")
    lines = customer.select(F.concat_ws(",", "c_custkey", noted, "c_nationkey").alias("line"))
    standins.write_lines(lines.coalesce(1), "C_CUSTKEY,NOTE,C_NATIONKEY", path)
    scan = scan_delimited(spark, path, ",", multi_line=True, split_bytes=max(1024, customer.count() * 3))
    columns = (("C_CUSTKEY", "c_custkey", "int"), ("NOTE", "note", "string"), ("C_NATIONKEY", "c_nationkey", "int"))
    return project_typed(scan.kept, columns)


def q_sniff_types(spark, sf_dir):
    """Types of an undeclared file of orders, found over all its lines, beside those declared for some columns."""
    order = F.col("o_orderkey")
    fields = [
        order, money("o_totalprice"), F.when(order % 7 == 0, F.lit("1.5e3")).otherwise(order.cast("string")),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.when(order % 3 == 0, F.date_format("o_orderdate", "M/d/yyyy")).otherwise(F.date_format("o_orderdate", "M/d/yyyy H:mm:ss")),
        (order % 2 == 0).cast("string"), F.lpad(order.cast("string"), 8, "0"),
        F.concat(order.cast("string"), F.when(order % 97 == 0, F.lit(" acres")).otherwise(F.lit(""))),
        F.lit(""), F.col("o_orderpriority"),
    ]
    path = scratch_path(spark, "undeclared")
    header = "KEY,PRICE,EXPONENT,DAY,STAMP,FLAG,CODE,MIXED,NOTHING,PRIORITY"
    lines = table(spark, sf_dir, "orders").select(
        F.concat_ws(",", *[F.coalesce(f.cast("string"), F.lit("")) for f in fields]).alias("line"))
    standins.write_lines(lines, header, path)
    return sniff_types(scan_delimited(spark, path).kept, {"Key": "bigint", "Price": "decimal(18,2)", "Code": "string"})


def q_scan_rejected(spark, sf_dir):
    return _customer_scan(spark, sf_dir).rejected


def q_staging_audit(spark, sf_dir):
    return _customer_scan(spark, sf_dir).audit("customer")


def q_lookup_normalize(spark, sf_dir):
    spec = LookupSpec("part_lup", "parts.txt", (
        ("Code", "code", "string"),
        ("Size", "size_code", "code4"),
        ("Description", "description", "string"),
        ("Flag", "is_flagged", "boolean"),
    ))
    flag = F.expr("""case p_type when 'ECONOMY' then ' Y' when 'LARGE' then 'no' when 'MEDIUM' then 'TRUE '
        when 'PROMO' then 'on' when 'SMALL' then '0' else 't' end""")
    line = F.concat_ws(
        "|", F.concat(F.lit(" "), F.col("p_partkey").cast("string")), F.col("p_size").cast("string"),
        F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")), flag,
    )
    folder = scratch_path(spark, "lookups")
    parts = table(spark, sf_dir, "part")
    standins.write_lines(parts.select(line), "Code|Size|Description|Flag", f"{folder}/{spec.file}")
    return load_lookup(spark, folder, spec)[0]


def q_typed_projection(spark, sf_dir):
    price = money("o_totalprice").cast("string")
    as_text = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("KEY"),
        F.when(F.col("o_orderstatus") == "P", F.lit("n/a"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("0.4999999"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("1.4999999999"))
        .otherwise(price).alias("PRICE"),
        F.concat(price, F.lit("e3")).alias("LARGE"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("DATED"),
        F.expr("case o_orderstatus when 'F' then 'Yes' when 'O' then '0' else 'on' end").alias("FLAG"),
    )
    return _doubles(project_typed(as_text, (
        ("key", "parcel_id", "string"),
        ("price", "whole", "int"),
        ("price", "amount", "decimal(10,2)"),
        ("price", "ratio", "double"),
        ("large", "capped", "decimal(10,2)"),
        ("dated", "at", "timestamp_ntz"),
        ("flag", "flag", "boolean"),
    )))


def q_timestamp_text(spark, sf_dir):
    text = F.expr("""case o_orderstatus
        when 'F' then date_format(o_orderdate, 'M/d/yyyy')
        when 'O' then date_format(o_orderdate, 'M/d/yyyy H:mm')
        else date_format(o_orderdate, 'yyyy-MM-dd') end""")
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_ts(text).alias("at"))


def q_table_profile(spark, sf_dir):
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
             "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
    return table_profile({name: table(spark, sf_dir, name) for name in names})


def q_warehouse_roundtrip(spark, sf_dir):
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.publish("fact_line", table(spark, sf_dir, "lineitem"), partition_by=["l_returnflag"])
    return warehouse.read("fact_line")


def q_polygon_layer(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    squares = customers.select(
        F.col("c_custkey").cast("string").alias("PARCELID"),
        (F.lit(700000.0) + F.col("c_custkey")).alias("x"),
        (F.lit(1300000.0) + 10 * F.col("c_nationkey")).alias("y"),
        (F.col("c_nationkey") + 1).cast("double").alias("half"),
    )
    folder = scratch_path(spark, "polygons")
    standins.write_square_layers(squares, folder)
    placed = centroids(read_polygons(spark, folder), "PARCELID")
    return placed.select("parcel_id", _rounded("longitude"), _rounded("latitude"))


# --- parcel features ---------------------------------------------------------------------------

def q_key_decompose(spark, sf_dir):
    parts = {"kind": (1, 8), "mark": (9, 1), "high": (10, 4), "low": (14, 5)}
    return key_decompose(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_name", parts)


def q_mmyy_dates(spark, sf_dir):
    number = F.expr("""case when o_orderstatus = 'P' then 0
        when o_orderpriority = '5-LOW' then (month(o_orderdate) + 12) * 100 + year(o_orderdate) % 100
        else month(o_orderdate) * 100 + year(o_orderdate) % 100 end""")
    primary = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", last_inspection(primary, number).alias("last_insp_date")
    )


def _with_recent(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_shipdate",
        money("l_extendedprice").alias("amount"),
    )
    return recent_activity(
        table(spark, sf_dir, "orders"), lines, "o_orderkey", "l_shipdate", "amount", AS_OF
    )


def q_recent_activity(spark, sf_dir):
    return _doubles(_with_recent(spark, sf_dir).select("o_orderkey", "recent_total", "has_recent"))


def q_classify_rules(spark, sf_dir):
    prefix = F.expr("lpad(cast((o_orderkey * 7 + o_custkey) % 101 as string), 2, '0')")
    homestead = F.expr("case o_orderstatus when 'F' then 0 when 'O' then 25000 end")
    taxable = F.expr("case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then null else o_totalprice end")
    stratum = basic_stratum(
        prefix, money("o_totalprice"), money("o_totalprice") / 2, taxable, homestead,
        F.col("recent_total") * 3, F.col("has_recent"),
    )
    return _with_recent(spark, sf_dir).select("o_orderkey", stratum.alias("stratum"))


# --- joins -------------------------------------------------------------------------------------

def _enriched(spark, sf_dir, hot_rows: int, fraction: float) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("custkey"), "o_orderpriority"
    )
    customer = table(spark, sf_dir, "customer").filter("c_acctbal >= 0").select(
        F.col("c_custkey").alias("custkey"), "c_name", F.col("c_nationkey").alias("nationkey")
    )
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    joined = left_enrich(orders, customer, "custkey", hot_rows, fraction)
    return left_enrich(joined, nation, "nationkey", hot_rows, fraction)


def q_enrich_left(spark, sf_dir):
    return _enriched(spark, sf_dir, 5_000_000, 0.01)


def q_enrich_left_fanout(spark, sf_dir):
    """Customers joined with their orders: the repeated keys are on the right, and some are hot."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    return left_enrich(customer, orders, "custkey", hot_rows=15, fraction=1.0)


def q_star_decode(spark, sf_dir):
    lookups = {name: table(spark, sf_dir, name) for name in ("nation", "region")}
    codes = (
        ("c_nationkey", "nation", "n_nationkey"),
        ("c_nationkey_n_regionkey", "region", "r_regionkey"),
    )
    decoded = decode(table(spark, sf_dir, "customer"), codes, lookups)
    return decoded.select(
        "c_custkey", F.col("c_nationkey_n_name").alias("nation"),
        F.col("c_nationkey_n_regionkey_r_name").alias("region"),
    )


# --- strata ------------------------------------------------------------------------------------

def q_stratum_collapse(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", money("c_acctbal").alias("balance")
    )
    out = stratum_collapse(
        customer, "c_nationkey", "balance", "active_stratum", eligible=(0, 20), share=0.045, into=99
    )
    return out.select("c_custkey", "c_nationkey", "active_stratum")


def _orders_by_priority(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", money("o_totalprice").alias("price")
    )


def _cumulative(**scan) -> Query:
    def query(spark, sf_dir):
        out = cumulative_share(
            _orders_by_priority(spark, sf_dir), ["o_orderpriority"], "price", "o_orderkey",
            "in_bottom", **scan,
        )
        return _doubles(out.select("o_orderkey", "running_total", "in_bottom"))

    return query


def _ranked(**scan) -> Query:
    def query(spark, sf_dir):
        parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
        out = ordered_totals(parts, ["p_type"], "p_size", "p_partkey", **scan)
        return out.select("p_partkey", "p_type", F.col("value_rank").alias("size_rank"))

    return query


def _grouped(**scan) -> Query:
    def query(spark, sf_dir):
        out = value_groups(
            _orders_by_priority(spark, sf_dir), ["o_orderpriority"], "price", "o_orderkey",
            "value_group", outlier_share=0.0005, **scan,
        )
        return out.select("o_orderkey", "o_orderpriority", "value_group")

    return query


def _grouped_all(**scan) -> Query:
    """Value groups of the whole table as one stratum."""

    def query(spark, sf_dir):
        out = value_groups(
            _orders_by_priority(spark, sf_dir), [], "price", "o_orderkey", "value_group",
            outlier_share=0.0001, **scan,
        )
        return out.select("o_orderkey", "value_group")

    return query


# --- ratio studies -----------------------------------------------------------------------------

def _sales(spark, sf_dir) -> DataFrame:
    """Lines as sales: quantity times list price stands for the assessed value."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_retailprice", "p_size")
    lines = table(spark, sf_dir, "lineitem")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    assessed = (F.col("l_quantity").cast("decimal(10,0)") * money("p_retailprice", "decimal(10,2)"))
    return joined.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "p_brand", "p_type",
        assessed.alias("assessed"), money("l_extendedprice", "decimal(12,2)").alias("price"),
    )


def q_sales_ratio(spark, sf_dir):
    ratio = F.round(sales_ratio(F.col("assessed"), F.col("price")), 9)
    return _sales(spark, sf_dir).select("l_orderkey", "l_linenumber", ratio.alias("ratio"))


def q_ratio_cod(spark, sf_dir):
    out = cod(_sales(spark, sf_dir), ["p_brand"], "assessed", "price")
    return out.select("p_brand", _rounded("cod"))


def q_ratio_prd(spark, sf_dir):
    out = prd(_sales(spark, sf_dir), ["l_returnflag"], "assessed", "price")
    return out.select("l_returnflag", _rounded("prd"))


def _study(df: DataFrame, *by: str, **median) -> DataFrame:
    out = ratio_study(df, list(by), "assessed", "price", **median)
    measures = ("median_ratio", "mean_ratio", "weighted_mean_ratio", "cod", "prd")
    return out.select(*by, "sales", *[_rounded(m) for m in measures])


def q_ratio_study(spark, sf_dir):
    return _study(_sales(spark, sf_dir), "p_brand")


def q_ratio_study_placed(spark, sf_dir):
    return _study(_sales(spark, sf_dir), "p_brand", **PLACED)


def q_ratio_study_all(spark, sf_dir):
    """The whole roll as one group."""
    return _study(_sales(spark, sf_dir))


def q_ratio_study_all_placed(spark, sf_dir):
    return _study(_sales(spark, sf_dir), **PLACED)


def q_ratio_study_filtered(spark, sf_dir):
    """Only sales whose transaction code and stratum are flagged; supplier and type stand for them."""
    suppliers = table(spark, sf_dir, "supplier").withColumn("flag", F.col("s_acctbal") > 0)
    parts = table(spark, sf_dir, "part")
    usual = parts.agg(F.avg("p_retailprice")).scalar()
    types = parts.groupBy(F.col("p_type").alias("stratum")).agg(F.avg("p_retailprice").alias("price"))
    types = types.withColumn("flag", F.col("price") > usual)
    sales = eligible_sales(_sales(spark, sf_dir), suppliers, "l_suppkey", "s_suppkey", "flag")
    return _study(eligible_sales(sales, types, "p_type", "stratum", "flag"), "l_returnflag")


# --- audits ------------------------------------------------------------------------------------

def q_fanout_audit(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber")
    return fanout_audit(orders, orders.join(lines, "key", "left"), "orders_with_lines")


def q_duplicate_keys(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "orders"), ["o_custkey"])


# --- clustering --------------------------------------------------------------------------------

def q_cluster_features(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "key")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("key"), F.col("l_quantity").cast("decimal(18,2)").alias("area")
    )
    attributes = {
        "value": F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")),
        "quality": F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")),
        "prefix": F.substring("o_orderpriority", 1, 2),
    }
    out = feature_table(orders, lines, "key", attributes, "area", "area", {"value": 0, "quality": "Unknown"})
    return _doubles(out)


def q_one_hot(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    encoded, flags = one_hot(parts, ["p_type", "p_brand"])
    return encoded.select("p_partkey", *[f"`{flag}`" for flag in flags])


def q_standardize(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
    out = standardize(parts, ["p_retailprice", "p_size"])
    return out.select("p_partkey", _rounded("p_retailprice"), _rounded("p_size"))


def q_elbow_select(spark, sf_dir):
    """Spread of line prices inside 2 to 10 equal-width bins, and each point's chord distance."""
    cents = table(spark, sf_dir, "lineitem").select(
        (money("l_extendedprice") * 100).cast("decimal(18,0)").alias("v")
    )
    ends = cents.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    at = F.floor((F.col("v") - F.col("e.lo")).cast("double") * F.col("k")
                 / (F.col("e.hi") - F.col("e.lo") + 1).cast("double"))
    binned = (
        cents.withColumn("e", ends)
        .withColumn("square", (F.col("v").cast("bigint") * F.col("v").cast("bigint")).cast("decimal(18,0)"))
        .select("v", "square", "e", F.explode(F.sequence(F.lit(2), F.lit(10))).alias("k"))
        .groupBy("k", at.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"),
            F.sum(F.col("square")).alias("s2"),
        )
    )
    spread = (F.col("n").cast("decimal(12,0)") * F.col("s2").cast("decimal(26,0)")
              - F.col("s").cast("decimal(19,0)") * F.col("s").cast("decimal(19,0)"))
    wcss = F.sum(spread.cast("double") / F.col("n")) / 1e12
    sweep = binned.groupBy("k").agg(wcss.alias("wcss"))
    return elbow(sweep).select("k", _rounded("wcss", 4), _rounded("distance", 5))


def _part_vectors(spark, sf_dir) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    return vectors_of(stage(parts), "p_partkey", ["p_size", "p_retailprice"], ["p_type"])


def q_kmeans_sweep(spark, sf_dir):
    return kmeans_sweep(_part_vectors(spark, sf_dir))[0]


def q_kmeans_assign(spark, sf_dir):
    vectors = _part_vectors(spark, sf_dir)
    sweep, models = kmeans_sweep(vectors)
    labels = assign_clusters(models[choose_k(sweep)], vectors, "p_partkey")
    return table(spark, sf_dir, "part").select("p_partkey", "p_name").join(labels.hint("merge"), "p_partkey", "left")


def q_parcel_clusters(spark, sf_dir):
    """The parcel features of the stand-in warehouse, clustered."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.expr("lpad(cast(l_orderkey as string), 18, '0')").alias("parcel_id"),
        F.col("l_quantity").alias("total_under_roof"),
    )
    described = left_enrich(
        standins.parcels(spark, sf_dir).select("parcel_id", "total_value", "dor_use_code"),
        standins.roll(spark, sf_dir).select("parcel_id", "market_area_code", "impvmt_quality"),
        "parcel_id",
    )
    labels, _ = cluster_parcels(
        parcel_features(described, lines), "parcel_id", CLUSTER_NUMBERS, CLUSTER_CATEGORIES
    )
    return labels


def q_kmeans_properties(spark, sf_dir):
    """Per k: rows and labels of the assignment, and its squared distances against the model's cost."""
    vectors = _part_vectors(spark, sf_dir)
    sweep, models = kmeans_sweep(vectors)
    costs = {row["k"]: row["wcss"] for row in sweep.collect()}
    checked = None
    for k, model in models.items():
        squared = vector_to_array("features")
        centres = F.array(*[F.lit(c.tolist()) for c in model.clusterCenters()])
        own = F.get(centres, F.col("prediction"))
        apart = F.aggregate(
            F.zip_with(squared, own, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
        # A table of every row is never broadcast, however few bytes its files have.
        labels = assign_clusters(model, vectors, "p_partkey").hint("merge")
        row = model.transform(vectors).select("p_partkey", apart.alias("apart")).join(labels, "p_partkey").agg(
            F.lit(k).alias("k"), F.count("p_partkey").alias("assigned"),
            F.count_distinct("cluster_label").alias("clusters"),
            (F.abs(F.sum("apart") - costs[k]) < 1e-6 * costs[k]).alias("cost_matches"),
            F.bool_and(F.col("cluster_label").rlike("^Cluster [1-9][0-9]*$")).alias("labels_match"),
        )
        checked = row if checked is None else checked.unionByName(row)
    return checked


def q_parcel_cluster_properties(spark, sf_dir):
    """Every parcel once, with a label of a k in range, and every label in use."""
    number = F.regexp_extract("cluster_label", "([0-9]+)$", 1).cast("int")
    return q_parcel_clusters(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("parcels"), F.count_distinct("parcel_id").alias("keys"),
        F.max(number).between(2, 10).alias("k_in_range"),
        F.bool_and(F.col("cluster_label").rlike("^Cluster [1-9][0-9]*$")).alias("labels_match"),
        (F.count_distinct("cluster_label") == F.max(number)).alias("all_used"),
    )


def q_cluster_join_back(spark, sf_dir):
    """Clusters published from stand-in tables, read back and joined to their parcels."""
    warehouse = VersionedWarehouse(spark, scratch_path(spark, "clusters"))
    described = left_enrich(
        standins.parcels(spark, sf_dir).select("parcel_id", "total_value", "dor_use_code"),
        standins.roll(spark, sf_dir).select("parcel_id", "market_area_code", "impvmt_quality"), "parcel_id",
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.expr("lpad(cast(l_orderkey as string), 18, '0')").alias("parcel_id"), F.col("l_quantity").alias("total_under_roof"))
    warehouse.publish("dim_parcels", described)
    warehouse.publish("fact_bldg", lines)
    ks = range(2, 6)
    sweep = publish_clusters(warehouse, ks)
    labels = warehouse.read("dim_parcel_clusters")
    names = [f"Cluster {number}" for number in range(1, max(ks) + 1)]
    used = labels.agg(F.count_distinct("cluster_label")).scalar()
    joined = warehouse.read("dim_parcels").join(labels.hint("merge"), "parcel_id", "left").groupBy("parcel_id").agg(
        F.count("cluster_label").alias("labels"), F.bool_and(F.col("cluster_label").isin(names)).alias("label_known"))
    return joined.select(
        "parcel_id", "labels", "label_known", used.between(2, max(ks)).alias("k_in_range"),
        F.lit(sweep.count()).cast("bigint").alias("tried"))


def q_versioned_tables(spark, sf_dir):
    """Orders published, halved and doubled as versions, one write left unfinished, old versions collected."""
    warehouse = VersionedWarehouse(spark, scratch_path(spark, "versions"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", money("o_totalprice").alias("price"))
    first = warehouse.publish("orders", orders)
    half = warehouse.replace("orders", warehouse.read("orders").filter("o_orderkey % 2 = 0"))
    last = warehouse.replace("orders", warehouse.read("orders").withColumn("price", F.col("price") * 2))
    warehouse._write(f"{warehouse._table('orders')}/data/{'9' * 12}-unfinished", orders.limit(1), None)
    gone = warehouse.collect("orders", keep=1)
    return warehouse.read("orders").select(
        "o_orderkey", F.col("price").cast("double").alias("price"), F.lit(first).alias("first_rows"),
        F.lit(half).alias("half_rows"), F.lit(last).alias("last_rows"), F.lit(gone).cast("bigint").alias("collected"))


def q_run_ledger(spark, sf_dir):
    """Two runs of the customer ingest, the first sent twice."""
    ledger = RunLedger(spark, scratch_path(spark, "ledger"))
    for run_id in ("2026-01", "2026-02", "2026-01"):
        warehouse, audit = VersionedWarehouse(spark, scratch_path(spark, "run")), Audit()
        ingest(warehouse, audit, "customer", _customer_scan(spark, sf_dir), lambda df: project_typed(df, _CUSTOMER_COLUMNS))
        ledger.record(run_id, audit.table(spark))
    return ledger.history().withColumn("timed", F.col("seconds") > 0).drop("seconds")


def q_one_hot_sparse(spark, sf_dir):
    """Stored values and width of the vectors of a number and two categories."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type", "p_brand")
    vectors = feature_vectors(parts, ["p_partkey"], ["p_size"], ["p_type", "p_brand"])
    shown = F.col("features")
    return vectors.select(
        "p_partkey",
        F.size(F.filter(vector_to_array(shown), lambda v: v != 0)).alias("stored"),
        F.size(vector_to_array(shown)).alias("width"),
    )


# --- geometry ----------------------------------------------------------------------------------

def q_polygon_centroid(spark, sf_dir):
    """Squares with a square hole, and triangles, by customer."""
    x = 700000.0 + F.col("c_custkey")
    y = 1300000.0 + 10.0 * F.col("c_nationkey")
    side = 100.0 + F.col("c_nationkey")

    def ring(*corners: tuple[Column, Column]) -> Column:
        points = [F.struct(a.cast("double").alias("x"), b.cast("double").alias("y")) for a, b in corners]
        return F.array(*points, points[0])

    outer = ring((x, y), (x, y + side), (x + side, y + side), (x + side, y))
    hole = ring((x + 20, y + 20), (x + 30, y + 20), (x + 30, y + 30), (x + 20, y + 30))
    triangle = ring((x, y), (x + 30, y + 60), (x + 90, y))
    rings = F.when(F.col("c_acctbal") < 0, F.array(triangle)).otherwise(F.array(outer, hole))
    at = table(spark, sf_dir, "customer").select("c_custkey", ring_centroid(rings).alias("at"))
    return at.select("c_custkey", F.round("at.x", 4).alias("x"), F.round("at.y", 4).alias("y"))


def q_project_coordinates(spark, sf_dir):
    feet = with_crs(standins.centroids_in_feet(spark, sf_dir, all_orders=True), "EPSG:2882")
    return project_coordinates(feet).select("parcel_id", _rounded("longitude"), _rounded("latitude"))


# --- whole builds ------------------------------------------------------------------------------

def dim_build(spark: SparkSession, sf_dir: str, rules: StudyRules = RULES) -> DataFrame:
    dim = build_dim_parcels(
        standins.parcels(spark, sf_dir), standins.roll(spark, sf_dir),
        standins.centroids_in_feet(spark, sf_dir), standins.permits(spark, sf_dir), rules,
    )
    return _degrees_rounded(to_degrees(dim, "longitude", "latitude"))


def _degrees_rounded(dim: DataFrame) -> DataFrame:
    return _doubles(dim.withColumns(
        {c: F.round(c, 6) for c in ("longitude", "latitude")}
    ))


def q_dim_build_placed(spark, sf_dir):
    rules = StudyRules(as_of=AS_OF, outlier_share=0.0005, plain_rows=300, strategy="placed")
    return dim_build(spark, sf_dir, rules)


# Large raw files on disk at once: while one table ends, another fills the cores.
_RAW_AT_ONCE = 2


def q_warehouse_build(spark, sf_dir):
    """Raw files made of the given tables, through the whole build, to degrees."""
    raw = scratch_path(spark, "raw")
    inputs = standins.raw_inputs(spark, sf_dir, raw)
    turns = BoundedSemaphore(_RAW_AT_ONCE)

    @contextmanager
    def held(name: str) -> Iterator[None]:
        """A table's raw files are made when their turn comes, and go once the table is published."""
        path, write = inputs[name]
        with turns if name in STAGING else nullcontext():
            try:
                write()
                yield
            finally:
                remove_path(spark, path)

    warehouse, _ = build_warehouse(spark, raw, scratch_path(spark, "warehouse"), RULES, held=held)
    reproject_dimension(warehouse)
    return _degrees_rounded(warehouse.read("dim_parcels"))


def _whole_cents(name: str) -> Column:
    """A number times 100 as a long, halves away from zero: as F.round, but without a decimal per value."""
    cents = F.col(name).cast("double") * 100
    even = F.rint(cents)
    return F.when(F.abs(cents - even) == 0.5, cents + F.signum(cents) * 0.5).otherwise(even).cast("long")


def _fact_profile(held: DataFrame, fact: str, spec) -> DataFrame:
    """Per column its fill and its ends, and the sum of digests of the whole rows, in one pass.

    Ends are found among the values as they are, and told as text or number after that.
    """
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")

    def row(name: str, filled: Column, *ends: Column) -> Column:
        labels = ("least", "most", "first_text", "last_text")
        return F.struct(
            F.lit(fact).alias("fact"), F.lit(name).alias("column_name"), filled.alias("filled"),
            *[end.alias(label) for end, label in zip(ends, labels)])

    columns, texts = {}, []
    for _, out, kind in spec.columns:
        first, last = F.min(out), F.max(out)
        if kind == "string":
            texts.append(F.col(out))
            ends = no_number, no_number, first, last
        elif kind == "timestamp_ntz":
            texts.append(F.col(out).cast("date").cast("string"))
            ends = no_number, no_number, F.date_format(first, "yyyy-MM-dd"), F.date_format(last, "yyyy-MM-dd")
        else:
            cents = F.col(out).cast("long") * 100 if kind == "int" else _whole_cents(out)
            texts.append(cents.cast("string"))
            ends = first.cast("double"), last.cast("double"), no_text, no_text
        columns[out] = row(out, F.count(out), *ends)
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 8), 16, 10).cast("long")
    columns["_rows"] = row("whole rows", F.count(F.lit(1)), no_number, no_number, F.sum(digest).cast("string"), no_text)
    return held.agg(*[made.alias(out) for out, made in columns.items()]).select(F.inline(F.array(*columns)))




def q_warehouse_facts(spark, sf_dir):
    """The six facts from raw files, each column by its fill and its ends; columns hold unlike values.

    A row of each fact holds the sum of digests of its whole rows, which tells values that changed places.
    """
    warehouse = Warehouse(spark, scratch_path(spark, "facts"))

    def publish(name: str) -> str:
        spec, fact = STAGING[name], name.replace("stg_", "fact_")
        # The raw text of a fact goes once its table is published.
        with scratch_scope(spark):
            path = f"{scratch_path(spark, 'raw')}/{spec.file}"
            standins.write_raw(standins.facts(spark, sf_dir, spec), spec, path, "|")
            delimiter = delimiter_by_names(spark, path, [column for column, _, _ in spec.columns])
            warehouse.publish(fact, project_typed(scan_delimited(spark, path, delimiter).kept, spec.columns))
        return fact

    with ThreadPoolExecutor(_RAW_AT_ONCE) as pool:
        published = list(pool.map(publish, standins.FACTS))
    profiles = [
        _fact_profile(warehouse.read(fact), fact, STAGING[name]) for name, fact in zip(standins.FACTS, published)]
    return reduce(DataFrame.unionByName, profiles)


def q_warehouse_lookups(spark, sf_dir):
    """All lookups from raw files: name, key, and the other columns as text."""
    folder, parts, found = scratch_path(spark, "lookups"), table(spark, sf_dir, "part"), None
    for spec in LOOKUPS.values():
        raw = [F.expr(value) for value, _ in standins.lookup_values(spec)]
        delimiter = spec.delimiter or ","
        header = delimiter.join(name for name, _, _ in spec.columns)
        standins.write_lines(parts.select(F.concat_ws(delimiter, *raw)), header, f"{folder}/{spec.file}")
        loaded = load_lookup(spark, folder, spec)[0]
        key, *others = [F.col(out).cast("string") for _, out, _ in spec.columns]
        rows = loaded.select(
            F.lit(spec.name).alias("lookup"), key.alias("key"), F.concat_ws("|", *others).alias("explained"))
        found = rows if found is None else found.unionByName(rows)
    return found


def q_star_decode_all(spark, sf_dir):
    """Every table of the code map decoded against its lookups, code by code."""
    sizes = table(spark, sf_dir, "part").groupBy("p_size").agg(F.max("p_name").alias("name"))
    lookups = {}
    for name, spec in LOOKUPS.items():
        (_, key, kind), *others = spec.columns
        code = F.col("p_size").cast("string")
        code = F.col("p_size").cast("int") if kind == "int" else F.lpad(code, 4, "0") if kind == "code4" else code
        lookups[name] = stage(sizes.select(
            code.alias(key), *[F.concat_ws(" ", F.lit(out), "name").alias(out) for _, out, _ in others]), "lookup")
    customer, found = table(spark, sf_dir, "customer"), None
    for name, codes in CODE_MAP.items():
        coded = customer.select("c_custkey", *[
            ((F.col("c_custkey") * (at + 1)) % 60).cast(
                "int" if dict((o, k) for _, o, k in LOOKUPS[lookup].columns)[key] == "int" else "string"
            ).alias(column) for at, (column, lookup, key) in enumerate(codes)
        ])
        decoded = decode_table(name, coded, lookups)
        told = [c for c in decoded.columns if c not in coded.columns]
        rows = decoded.select(
            F.lit(name).alias("table_name"), "c_custkey",
            F.concat_ws("|", *[F.coalesce(c, F.lit("-")) for c in told]).alias("decoded"))
        found = rows if found is None else found.unionByName(rows)
    return found


QUERIES: dict[str, Query] = {
    "scan_delimited": q_scan_delimited,
    "scan_line_breaks": q_scan_line_breaks,
    "sniff_types": q_sniff_types,
    "scan_rejected": q_scan_rejected,
    "staging_audit": q_staging_audit,
    "lookup_normalize": q_lookup_normalize,
    "typed_projection": q_typed_projection,
    "timestamp_text": q_timestamp_text,
    "table_profile": q_table_profile,
    "warehouse_roundtrip": q_warehouse_roundtrip,
    "polygon_layer": q_polygon_layer,
    "key_decompose": q_key_decompose,
    "mmyy_dates": q_mmyy_dates,
    "recent_activity": q_recent_activity,
    "classify_rules": q_classify_rules,
    "enrich_left": q_enrich_left,
    "enrich_left_fanout": q_enrich_left_fanout,
    "star_decode": q_star_decode,
    "stratum_collapse": q_stratum_collapse,
    "cumulative_share": _cumulative(),
    "cumulative_share_placed": _cumulative(**PLACED),
    "rank_in_stratum": _ranked(),
    "rank_in_stratum_placed": _ranked(strategy="placed", rows_per_place=500),
    "value_groups": _grouped(),
    "value_groups_placed": _grouped(**PLACED),
    "value_groups_all": _grouped_all(),
    "value_groups_all_placed": _grouped_all(**PLACED),
    "sales_ratio": q_sales_ratio,
    "ratio_cod": q_ratio_cod,
    "ratio_prd": q_ratio_prd,
    "ratio_study": q_ratio_study,
    "ratio_study_placed": q_ratio_study_placed,
    "ratio_study_all": q_ratio_study_all,
    "ratio_study_all_placed": q_ratio_study_all_placed,
    "ratio_study_filtered": q_ratio_study_filtered,
    "fanout_audit": q_fanout_audit,
    "duplicate_keys": q_duplicate_keys,
    "cluster_features": q_cluster_features,
    "one_hot": q_one_hot,
    "standardize": q_standardize,
    "elbow_select": q_elbow_select,
    "kmeans_sweep": q_kmeans_sweep,
    "kmeans_assign": q_kmeans_assign,
    "parcel_clusters": q_parcel_clusters,
    "kmeans_properties": q_kmeans_properties,
    "parcel_cluster_properties": q_parcel_cluster_properties,
    "cluster_join_back": q_cluster_join_back,
    "versioned_tables": q_versioned_tables,
    "run_ledger": q_run_ledger,
    "one_hot_sparse": q_one_hot_sparse,
    "polygon_centroid": q_polygon_centroid,
    "project_coordinates": q_project_coordinates,
    "dim_build": dim_build,
    "dim_build_placed": q_dim_build_placed,
    "warehouse_build": q_warehouse_build,
    "warehouse_facts": q_warehouse_facts,
    "warehouse_lookups": q_warehouse_lookups,
    "star_decode_all": q_star_decode_all,
}

"""Parcel-shaped staging tables made of the given order, customer and line tables.

They let the operators run on data that grows: an order stands for a parcel, its lines for permits
and buildings, its customer for roll attributes.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions.stateplane import FLORIDA_WEST_FT, TransverseMercator
from cadastra.sources.contracts import LOOKUPS, POLYGON_LAYER, STAGING
from cadastra.sources.polygons import file_system

# Rows of a polygon layer; as many as Spark's own Arrow batches have.
LAYER_ROWS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(name: str, kind: str = "decimal(18,2)") -> Column:
    return F.col(name).cast(kind)


def _pad(name: str) -> str:
    return f"lpad(cast({name} as string), 18, '0')"


def _typed(df: DataFrame, staging: str, columns: dict[str, str], also: dict[str, str]) -> DataFrame:
    """Columns of a staging table from SQL expressions, in the declared types."""
    kinds = {out: kind for _, out, kind in STAGING[staging].columns}
    return df.select(
        *[F.expr(e).try_cast(kinds.get(out, also.get(out))).alias(out) for out, e in columns.items()]
    )


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = "cast(o_totalprice as decimal(10,2))"
    return _typed(table(spark, sf_dir, "orders"), "stg_parcel", {
        "parcel_id": _pad("o_orderkey"),
        "dor_use_code": "concat(lpad(cast((o_orderkey * 7 + o_custkey) % 100 as string), 2, '0'), '00')",
        "nbrhd_code": "o_custkey",
        "nbrhd_desc": "o_orderpriority",
        "homestead": "case o_orderstatus when 'F' then 0 when 'O' then 25000 end",
        "ag_land_value": "o_custkey",
        "agri_class": "o_orderstatus",
        "valuation_code": "substring(o_orderpriority, 1, 1)",
        "valuation_desc": "o_orderpriority",
        "appr_land_value": "o_custkey * 2",
        "appr_bldg_value": "o_custkey * 3",
        "appr_ext_feat_value": "0",
        "total_value": "floor(cast(o_totalprice as decimal(18,2)))",
        "on_reconcile": "o_orderstatus",
        "assessed_value": price,
        "base_tax_value": f"""case when o_orderstatus = 'F' then 0
            when o_orderstatus = 'O' or o_orderpriority <> '1-URGENT' then {price} end""",
        "year_created": "year(o_orderdate)",
        "year_improved": "year(o_orderdate) + 1",
        "last_insp_date": "case when o_orderstatus = 'O' then o_orderdate end",
        "total_acreage": "o_custkey",
        "prior_parcel_id": _pad("o_custkey"),
    }, {})


def roll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll attributes; parcels of finished orders have none."""
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    joined = orders.join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return _typed(joined, "stg_nal", {
        "parcel_id": _pad("o_orderkey"),
        "asmnt_year": "year(o_orderdate)",
        "basic_stratum": "substring(o_orderpriority, 1, 1)",
        "active_stratum": "o_orderstatus",
        "group_num": "substring(c_mktsegment, 1, 2)",
        "jv_dor": "o_totalprice",
        "jv_dor_change": "c_acctbal",
        "jv_dor_change_code": "o_orderstatus",
        "new_const_val_last_yr": "0",
        "new_delete_val_last_yr": "cast(null as double)",
        "spass_code": "substring(c_mktsegment, 1, 3)",
        "parcel_split": "'N'",
        "disaster_code": "substring(c_mktsegment, 1, 1)",
        "disaster_year": "cast(null as int)",
        "last_inspect_date": """case when c_acctbal < 0 then 0
            else month(o_orderdate) * 100 + year(o_orderdate) % 100 end""",
        "impvmt_quality": "c_mktsegment",
        "market_area_code": "lpad(cast(c_nationkey as string), 2, '0')",
        "public_land": "'N'",
    }, {})


def degrees_of_orders(spark: SparkSession, sf_dir: str, all_orders: bool = False) -> DataFrame:
    """A place in degrees, on a grid of 1e-5, for every order, or all but the low-priority ones."""
    orders = table(spark, sf_dir, "orders")
    if not all_orders:
        orders = orders.filter("o_orderpriority <> '5-LOW'")
    return orders.select(
        F.expr(_pad("o_orderkey")).alias("parcel_id"),
        (F.round((F.col("o_orderkey") % 90001) / 100000, 5) - 82.05).alias("lon"),
        (F.round((F.col("o_custkey") % 70001) / 100000, 5) + 27.65).alias("lat"),
    )


def to_feet(df: DataFrame, lon: str, lat: str, zone: TransverseMercator = FLORIDA_WEST_FT) -> DataFrame:
    """Degrees → map feet in columns ``x``, ``y``, to have something to project back."""
    c0, c2, c4, c6 = zone.meridian_factors()
    second = zone.e2 / (1 - zone.e2)
    phi = F.radians(lat)
    cos, tan2 = F.cos(phi), F.pow(F.tan(phi), F.lit(2))
    normal = zone.semi_major / F.sqrt(1 - zone.e2 * F.sin(phi) * F.sin(phi))
    c = second * cos * cos
    a = F.radians(F.col(lon) - zone.central_meridian) * cos
    distance = zone.semi_major * (
        c0 * phi - c2 * F.sin(2 * phi) + c4 * F.sin(4 * phi) - c6 * F.sin(6 * phi)
    )
    easting = zone.scale * normal * (
        a
        + (1 - tan2 + c) * a**3 / 6
        + (5 - 18 * tan2 + tan2**2 + 72 * c - 58 * second) * a**5 / 120
    )
    northing = zone.scale * (
        distance - zone.meridian_at_origin()
        + normal * F.tan(phi) * (
            a**2 / 2
            + (5 - tan2 + 9 * c + 4 * c**2) * a**4 / 24
            + (61 - 58 * tan2 + tan2**2 + 600 * c - 330 * second) * a**6 / 720
        )
    )
    return df.withColumns({
        "x": (easting + zone.false_easting) / zone.unit,
        "y": (northing + zone.false_northing) / zone.unit,
    })


def centroids_in_feet(spark: SparkSession, sf_dir: str, all_orders: bool = False) -> DataFrame:
    placed = to_feet(degrees_of_orders(spark, sf_dir, all_orders), "lon", "lat")
    return placed.select("parcel_id", F.col("x").alias("longitude"), F.col("y").alias("latitude"))


def permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(table(spark, sf_dir, "lineitem"), "stg_permit", {
        "parcel_id": _pad("l_orderkey"),
        "permit_id": "l_orderkey * 10 + l_linenumber",
        "permit_agency": "l_returnflag",
        "permit_num": "cast(l_partkey as string)",
        "permit_status": "l_linestatus",
        "permit_desc": "concat('Line ', l_linenumber, ', part ', l_partkey)",
        "permit_type": "l_returnflag",
        "issue_date": "l_shipdate - interval 30 days",
        "final_insp_date": "l_shipdate",
        "est_value": "floor(cast(l_extendedprice as decimal(18,2))) * 4",
        "site_street_num": "cast(l_suppkey as string)",
        "site_street_pfx": "'N'",
        "site_street_name": "'MAIN'",
        "site_street_sfx": "'ST'",
        "site_apt_num": "cast(null as string)",
    }, {})


def _any_row(spec, source: DataFrame, key: str, number: str, text: str) -> DataFrame:
    """A table of any contract: its key, and one number or text for all other columns."""
    columns = {}
    for _, out, kind in spec.columns:
        if kind == "string":
            columns[out] = text
        elif kind == "timestamp_ntz":
            columns[out] = "l_shipdate"
        else:
            columns[out] = number
    columns["parcel_id"] = _pad(key)
    return _typed(source, spec.name, columns, {})


FACTS = ("stg_bldg", "stg_land", "stg_misc", "stg_permit", "stg_sales", "stg_site")


def fact_values(spec) -> dict[str, str]:
    """An expression over the line table per column of a contract, no two columns alike.

    The expressions mean the same in both engines that compare them.
    """
    values = {}
    for at, (_, out, kind) in enumerate(spec.columns):
        if out == "parcel_id":
            values[out] = _pad("l_orderkey").replace("string", "varchar(20)")
        elif kind == "string":
            values[out] = f"concat('{out}-', cast(l_linenumber as varchar(9)))"
        elif kind == "timestamp_ntz":
            values[out] = f"l_shipdate + interval '{at}' day"
        else:
            part = {"int": "0", "double": "0.5"}.get(kind, "0.25")
            values[out] = f"l_linenumber * 100 + {at} + {part}"
    return values


def facts(spark: SparkSession, sf_dir: str, spec) -> DataFrame:
    return _typed(table(spark, sf_dir, "lineitem"), spec.name, fact_values(spec), {})


def lookup_values(spec) -> list[tuple[str, str]]:
    """Per column of a lookup, the raw text over the part table and what it must become."""
    found = []
    for at, (_, out, kind) in enumerate(spec.columns):
        key, text = "cast(p_partkey as varchar(20))", f"concat('{out} ', cast(p_size as varchar(9)))"
        if kind == "boolean":
            found.append(("case when p_size % 2 = 0 then ' Y' else 'no' end",
                          "case when p_size % 2 = 0 then 'true' else 'false' end"))
        elif kind == "code4":
            found.append((key, f"lpad({key}, 4, '0')"))
        elif kind == "as written":
            found.append((f"concat(' ', {text}, ' ')",) * 2)
        elif at == 0:
            found.append((key if kind == "int" else f"concat('  ', {key}, ' ')", key))
        else:
            found.append((f"concat(' ', {text}, '  ')", text))
    return found


# Packed files are read whole by one task each, so they are kept small.
PACKED_ROWS = 500_000


def write_lines(lines: DataFrame, header: str, path: str, packed: bool = False) -> None:
    """Write text lines as files that each begin with the header line; ``packed`` ones are compressed."""
    writer = lines.toDF(header).write.option("header", True).option("quote", "").option(
        "sep", "\x01"
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if packed:
        writer = writer.option("compression", "lz4").option("maxRecordsPerFile", PACKED_ROWS)
    writer.csv(path)


def _as_text(column: Column, kind: str) -> Column:
    text = F.date_format(column, "M/d/yyyy H:mm:ss") if kind == "timestamp_ntz" else column.cast("string")
    return F.coalesce(text, F.lit(""))


def write_raw(df: DataFrame, spec, path: str, delimiter: str) -> None:
    """Write a typed table as raw files of its contract, every text value quoted; packed, as they are many times its size."""
    fields = []
    for _, out, kind in spec.columns:
        text = _as_text(F.col(out), kind)
        fields.append(F.concat(F.lit('"'), text, F.lit('"')) if kind == "string" else text)
    header = delimiter.join(raw for raw, _, _ in spec.columns)
    write_lines(df.select(F.concat_ws(delimiter, *fields)), header, path, packed=True)


def raw_inputs(spark: SparkSession, sf_dir: str, raw: str) -> dict[str, tuple[str, Callable[[], None]]]:
    """Per raw input of the warehouse build its path under ``raw``, and what writes it."""
    lines = table(spark, sf_dir, "lineitem")
    made = {
        "stg_parcel": parcels(spark, sf_dir),
        "stg_nal": roll(spark, sf_dir),
        "stg_permit": permits(spark, sf_dir),
        "stg_bldg": _any_row(STAGING["stg_bldg"], lines, "l_orderkey", "l_quantity", "l_returnflag"),
        "stg_land": _any_row(STAGING["stg_land"], lines, "l_orderkey", "l_linenumber", "l_linestatus"),
        "stg_misc": _any_row(STAGING["stg_misc"], lines, "l_orderkey", "l_linenumber", "l_returnflag"),
        "stg_sales": _any_row(STAGING["stg_sales"], lines, "l_orderkey", "l_quantity", "l_returnflag"),
        "stg_site": _any_row(STAGING["stg_site"], lines, "l_orderkey", "l_linenumber", "l_linestatus"),
    }
    parts = table(spark, sf_dir, "part")

    def write_staging(name: str, path: str) -> None:
        write_raw(made[name], STAGING[name], path, "," if name == "stg_nal" else "|")

    def write_lookup(name: str, path: str) -> None:
        spec = LOOKUPS[name]
        header = (spec.delimiter or ",").join(name for name, _, _ in spec.columns)
        fields = [F.col("p_partkey").cast("string"), *[F.lit(" Y ")] * (len(spec.columns) - 1)]
        write_lines(parts.select(F.concat_ws(spec.delimiter or ",", *fields)), header, path)

    def write_layers(name: str, path: str) -> None:
        write_square_layers(to_feet(degrees_of_orders(spark, sf_dir), "lon", "lat").select(
            F.col("parcel_id").alias("PARCELID"), "x", "y", F.lit(50.0).alias("half")
        ), path)

    inputs = {name: (f"{raw}/{STAGING[name].file.replace('*', 'roll')}", write_staging) for name in made}
    inputs |= {name: (f"{raw}/lookups/{spec.file}", write_lookup) for name, spec in LOOKUPS.items()}
    inputs["stg_gis"] = f"{raw}/{POLYGON_LAYER}", write_layers
    return {name: (path, partial(write, name, path)) for name, (path, write) in inputs.items()}


def write_raw_files(spark: SparkSession, sf_dir: str, raw: str) -> None:
    """All raw inputs of the warehouse build under ``raw``."""
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda made: made[1](), raw_inputs(spark, sf_dir, raw).values()))


def write_square_layers(df: DataFrame, folder: str) -> int:
    """Write squares (id, x, y, half side) as polygon layers of some ``LAYER_ROWS`` rows; returns the rows.

    Layers don't follow the session's Arrow batches, which the text operators make small.
    """
    key = df.columns[0]

    def write(batches):
        for rows in _together(batches, LAYER_ROWS):
            centres = rows[["x", "y", "half"]].to_numpy(float)
            _write_layer(f"{folder}/{uuid.uuid4().hex}", key, rows[key].tolist(), centres)
            yield pd.DataFrame({"rows": [len(rows)]})

    return df.mapInPandas(write, "rows bigint").agg(F.sum("rows")).first()[0]


def _together(batches: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    """Neighbouring batches put together until they have ``least`` rows; the last ones may have fewer."""
    held, rows = [], 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            rows += len(batch)
        if rows >= least:
            yield pd.concat(held)
            held, rows = [], 0
    if held:
        yield pd.concat(held)


def _write_layer(stem: str, key: str, ids: list[str], squares: np.ndarray) -> None:
    """Main, index and table file of closed clockwise squares."""
    x, y, half = squares.T
    corner_x = np.stack([x - half, x - half, x + half, x + half, x - half], axis=1)
    corner_y = np.stack([y - half, y + half, y + half, y - half, y - half], axis=1)
    size = 4 + 32 + 8 + 4 + 16 * 5
    records = np.zeros(len(ids), dtype=np.dtype([
        ("number", ">i4"), ("words", ">i4"), ("kind", "<i4"), ("box", "<f8", 4),
        ("parts", "<i4"), ("points", "<i4"), ("first", "<i4"), ("xy", "<f8", (5, 2)),
    ]))
    records["number"] = np.arange(1, len(ids) + 1)
    records["words"] = size // 2
    records["kind"], records["parts"], records["points"] = 5, 1, 5
    records["box"] = np.stack([x - half, y - half, x + half, y + half], axis=1)
    records["xy"] = np.stack([corner_x, corner_y], axis=2)
    index = np.zeros(len(ids), dtype=[("offset", ">i4"), ("words", ">i4")])
    index["offset"] = 50 + np.arange(len(ids)) * (size + 8) // 2
    index["words"] = size // 2

    def head(body: int) -> bytes:
        box = [(x - half).min(), (y - half).min(), (x + half).max(), (y + half).max()]
        return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + body) // 2) + struct.pack(
            "<2i8d", 1000, 5, *box, 0, 0, 0, 0
        )

    width = max(len(i) for i in ids)
    fields = struct.pack("<11sc4xB15x", key.encode(), b"C", width) + b"\r"
    rows = b"".join(b" " + i.encode().ljust(width) for i in ids)
    system, inside = file_system(stem)
    system.create_dir(inside.rpartition("/")[0], recursive=True)
    table = struct.pack("<4BIHH20x", 3, 126, 1, 1, len(ids), 32 + len(fields), 1 + width)
    for suffix, data in (
        (".shp", head(records.nbytes) + records.tobytes()), (".shx", head(index.nbytes) + index.tobytes()),
        (".dbf", table + fields + rows + b"\x1a"),
    ):
        with system.open_output_stream(inside + suffix) as f:
            f.write(data)

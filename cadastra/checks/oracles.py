"""SQL for the same results, over the given tables registered under their own names."""

from __future__ import annotations

from cadastra.checks.standins import FACTS, fact_values, lookup_values
from cadastra.sources.contracts import CODE_MAP, LOOKUPS, STAGING

AS_OF = "TIMESTAMP '2001-08-01'"
SINCE = "TIMESTAMP '2001-02-01'"

_RECENT = f"""
    SELECT l_orderkey AS k, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS total
    FROM lineitem WHERE l_shipdate BETWEEN {SINCE} AND {AS_OF} GROUP BY l_orderkey
"""

_SALES = """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, p_brand, p_type,
           CAST(l_quantity AS DECIMAL(10,0)) * CAST(p_retailprice AS DECIMAL(10,2)) AS av,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS sp
    FROM lineitem JOIN part ON l_partkey = p_partkey
"""


def _study(by: str, where: str = "TRUE", measures: str | None = None) -> str:
    """Ratio statistics per group; the median is taken first, then the distances from it."""
    measures = measures or """COUNT(*) AS sales, ROUND(ANY_VALUE(med), 6) AS median_ratio,
        ROUND(AVG(r), 6) AS mean_ratio,
        ROUND(SUM(av)::DOUBLE / SUM(sp)::DOUBLE, 6) AS weighted_mean_ratio,
        ROUND(100 * AVG(ABS(r - med)) / ANY_VALUE(med), 6) AS cod,
        ROUND(AVG(r) / (SUM(av)::DOUBLE / SUM(sp)::DOUBLE), 6) AS prd"""
    return f"""
    WITH s AS ({_SALES}),
    q AS (SELECT *, av::DOUBLE / sp::DOUBLE AS r FROM s WHERE sp > 0 AND {where}),
    m AS (SELECT {by} AS g, MEDIAN(r) AS med FROM q GROUP BY {by})
    SELECT {by}, {measures} FROM q JOIN m ON {by} = g GROUP BY {by}
    """


def _study_all() -> str:
    """The same statistics of all sales as one group."""
    measures = _study("g").split("SELECT g, ")[1].split(" FROM q JOIN")[0]
    return f"""
    WITH s AS ({_SALES}), q AS (SELECT *, av::DOUBLE / sp::DOUBLE AS r FROM s WHERE sp > 0),
    m AS (SELECT MEDIAN(r) AS med FROM q)
    SELECT {measures} FROM q, m
    """


def _basic_stratum(code: str, total: str, assessed: str, taxable: str, homestead: str, recent: str, flag: str) -> str:
    """Strata by number of the use code: fields ``n``, ``farm`` and ``public`` over one row."""
    n = f"CAST({code} AS INTEGER)"
    farm = f"({n} BETWEEN 50 AND 69 OR {n} = 97)"
    public = f"({n} BETWEEN 70 AND 96 OR {n} = 98)"
    return f"""CASE
        WHEN {flag} AND NOT {farm} AND {recent} > {total} THEN 11
        WHEN {flag} AND {farm} AND {recent} > {assessed} THEN 12
        WHEN {farm} THEN CASE WHEN {homestead} > 0 THEN 9 WHEN {homestead} <= 0 THEN 3 END
        WHEN {public} THEN CASE WHEN {taxable} > 0 THEN 7 WHEN {taxable} <= 0 THEN 10 END
        WHEN {n} IN (1, 2, 4, 5) THEN 1
        WHEN {n} IN (6, 8) THEN 2
        WHEN {n} IN (0, 7) THEN 4
        WHEN {n} IN (10, 40, 99) THEN 5
        WHEN {n} = 9 THEN 13
        WHEN {n} = 3 OR {n} BETWEEN 11 AND 49 THEN 6
    END"""


def _groups(source: str, part: str, value: str, tie: str, outlier: str) -> str:
    """CTEs from ``source`` to ``grouped``, which has its columns and the value group ``grp``."""
    return f"""
    seen AS (
        SELECT *, SUM({value}) OVER w AS whole,
               SUM({value}) OVER (w ORDER BY {value} NULLS LAST, {tie} NULLS LAST) AS sofar,
               RANK() OVER (w ORDER BY {value} NULLS LAST) AS place
        FROM {source} WINDOW w AS (PARTITION BY {part})
    ),
    marked AS (
        SELECT *, COALESCE(sofar * 20 <= whole, FALSE) AS low,
               COALESCE(sofar * 20 > whole AND {value} >= (whole - whole * 0.05) * {outlier}, FALSE) AS high
        FROM seen
    ),
    sized AS (
        SELECT *, place - COUNT(*) FILTER (low) OVER w AS pos,
               COUNT({tie}) OVER w - COUNT(*) FILTER (low OR high) OVER w AS many
        FROM marked WINDOW w AS (PARTITION BY {part})
    ),
    grouped AS (
        SELECT *, CASE WHEN low THEN 5 WHEN high THEN 6 WHEN many = 0 THEN 4
                WHEN pos::DOUBLE / many <= 0.25 THEN 1 WHEN pos::DOUBLE / many <= 0.5 THEN 2
                WHEN pos::DOUBLE / many <= 0.75 THEN 3 ELSE 4 END AS grp
        FROM sized
    )"""


_VALUE_GROUPS = f"""
WITH priced AS (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders),
{_groups('priced', 'o_orderpriority', 'price', 'o_orderkey', '0.0005')}
SELECT o_orderkey, o_orderpriority, grp AS value_group FROM grouped
"""

_VALUE_GROUPS_ALL = f"""
WITH priced AS (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders),
{_groups('priced', '1', 'price', 'o_orderkey', '0.0001')}
SELECT o_orderkey, grp AS value_group FROM grouped
"""

_CUMULATIVE = """
WITH priced AS (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders),
summed AS (
    SELECT o_orderkey, SUM(price) OVER (w ORDER BY price, o_orderkey) AS sofar, SUM(price) OVER w AS whole
    FROM priced WINDOW w AS (PARTITION BY o_orderpriority)
)
SELECT o_orderkey, sofar::DOUBLE AS running_total, sofar * 20 <= whole AS in_bottom FROM summed
"""

_RANKED = """
SELECT p_partkey, p_type, RANK() OVER (PARTITION BY p_type ORDER BY p_size) AS size_rank FROM part
"""

_KEY = "lpad(CAST({} AS VARCHAR), 18, '0')"
_CENTS = "CAST(o_totalprice AS DECIMAL(10,2))"

_ACTIVE = f"""
WITH parcel AS (
    SELECT o.*, {_KEY.format('o_orderkey')} AS parcel_id,
           lpad(CAST((o_orderkey * 7 + o_custkey) % 100 AS VARCHAR), 2, '0') AS uc,
           CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 25000 END AS hx,
           CAST(FLOOR(CAST(o_totalprice AS DECIMAL(18,2))) AS INTEGER) AS tv,
           {_CENTS} AS av,
           CASE WHEN o_orderstatus = 'F' THEN 0
                WHEN o_orderstatus = 'O' OR o_orderpriority <> '1-URGENT' THEN {_CENTS} END AS xv,
           COALESCE(p.total, 0) AS pv, p.k IS NOT NULL AS pf
    FROM orders o LEFT JOIN (
        SELECT l_orderkey AS k, SUM(CAST(FLOOR(CAST(l_extendedprice AS DECIMAL(18,2))) * 4 AS BIGINT)) AS total
        FROM lineitem WHERE l_shipdate BETWEEN {SINCE} AND {AS_OF} GROUP BY l_orderkey
    ) p ON p.k = o.o_orderkey
),
basic AS (
    SELECT *, {_basic_stratum('uc', 'tv', 'av', 'xv', 'hx', 'pv', 'pf')} AS bs FROM parcel
),
shares AS (
    SELECT bs AS b, SUM(av) AS held, SUM(SUM(av)) FILTER (bs BETWEEN 1 AND 7) OVER () AS held_1_7
    FROM basic GROUP BY bs
),
active AS (
    SELECT basic.*, CASE WHEN bs BETWEEN 1 AND 7 AND held * 20 < held_1_7 THEN 8 ELSE bs END AS acs
    FROM basic JOIN shares ON bs IS NOT DISTINCT FROM b
),
"""


def _dim() -> str:
    head = _ACTIVE + _groups("active", "acs", "tv", "parcel_id", "0.0005")
    has_roll = "o_orderstatus <> 'F'"

    def roll(expression: str) -> str:
        return f"CASE WHEN {has_roll} THEN {expression} END"

    placed = "o_orderpriority <> '5-LOW'"
    columns = {
        "parcel_id": "parcel_id",
        "rts": "parcel_id[1:6]",
        "range_code": "parcel_id[1:2]",
        "township_code": "parcel_id[3:4]",
        "section_code": "parcel_id[5:6]",
        "sub_code": "parcel_id[7:12]",
        "parcel_code": "parcel_id[13:18]",
        "latitude": f"CASE WHEN {placed} THEN ROUND((o_custkey % 70001) / 100000 + 27.65, 6)::DOUBLE END",
        "longitude": f"CASE WHEN {placed} THEN ROUND((o_orderkey % 90001) / 100000 - 82.05, 6)::DOUBLE END",
        "dor_use_code": "uc || '00'",
        "nbrhd_code": "o_custkey::DOUBLE",
        "nbrhd_desc": "o_orderpriority",
        "homestead": "hx::DOUBLE",
        "agri_class": "o_orderstatus",
        "total_acreage": "o_custkey::DOUBLE",
        "year_created": "YEAR(o_orderdate)::INTEGER",
        "year_improved": "(YEAR(o_orderdate) + 1)::INTEGER",
        "prior_parcel_id": _KEY.format("o_custkey"),
        "market_area_code": roll("lpad(c_nationkey::VARCHAR, 2, '0')"),
        "public_land": roll("'N'"),
        "valuation_code": "o_orderpriority[1]",
        "valuation_desc": "o_orderpriority",
        "ag_land_value": "o_custkey::INTEGER",
        "appr_land_value": "(o_custkey * 2)::INTEGER",
        "appr_bldg_value": "(o_custkey * 3)::INTEGER",
        "appr_ext_feat_value": "0",
        "total_value": "tv",
        "jv_dor": roll("o_totalprice"),
        "jv_dor_change": roll("c_acctbal"),
        "jv_dor_change_code": roll("o_orderstatus"),
        "new_const_val_last_yr": roll("0::DOUBLE"),
        "new_delete_val_last_yr": "NULL::DOUBLE",
        "on_reconcile": "o_orderstatus",
        "assessed_value": "av::DOUBLE",
        "base_tax_value": "xv::DOUBLE",
        "asmnt_year": roll("YEAR(o_orderdate)::INTEGER"),
        "basic_stratum": roll("o_orderpriority[1]"),
        "active_stratum": roll("o_orderstatus"),
        "group_num": roll("c_mktsegment[1:2]"),
        "spass_code": roll("c_mktsegment[1:3]"),
        "parcel_split": roll("'N'"),
        "disaster_code": roll("c_mktsegment[1]"),
        "disaster_year": "NULL::INTEGER",
        "impvmt_quality": roll("c_mktsegment"),
        "last_insp_date": """CASE WHEN o_orderstatus = 'O' THEN o_orderdate
            WHEN o_orderstatus = 'P' AND c_acctbal >= 0 THEN date_trunc('month', o_orderdate)::TIMESTAMP END""",
        "my_basic_stratum": "bs",
        "my_active_stratum": "acs",
        "has_recent_final_inspect": "pf",
        "recent_permit_total_value": "pv::DOUBLE",
        "my_group_number": "grp",
    }
    select = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    return f"{head} SELECT {select} FROM grouped LEFT JOIN customer ON c_custkey = o_custkey"


_PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
_BRANDS = sorted(f"Brand#{number}" for number in range(1, 26))
_ONE_HOT = ", ".join(
    f"""(({column} = '{value}')::INTEGER) AS "{column}_{value}\""""
    for column, values in (("p_type", _PART_TYPES), ("p_brand", _BRANDS))
    for value in values[1:]
)

_PROFILE = " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, COUNT(*) AS row_count,
        (SELECT COUNT(*) FROM (DESCRIBE {name}))::INTEGER AS column_count FROM {name}"""
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
)

def _facts() -> str:
    """Fill and ends of every fact column, and digests of whole rows, from what the raw files were made of."""
    parts = []
    for name in FACTS:
        texts = []
        for (_, out, kind), value in zip(STAGING[name].columns, fact_values(STAGING[name]).values()):
            text = kind in ("string", "timestamp_ntz")
            if kind == "timestamp_ntz":
                value = f"strftime({value}, '%Y-%m-%d')"
            elif kind == "int":
                value = f"round({value})"
            texts.append(value if text else f"cast(cast(round(({value})::DOUBLE * 100) as bigint) as varchar)")
            ends = f"NULL::DOUBLE AS least, NULL::DOUBLE AS most, min({value}) AS first_text, max({value}) AS last_text"
            if not text:
                ends = (f"min({value})::DOUBLE AS least, max({value})::DOUBLE AS most, "
                        "NULL::VARCHAR AS first_text, NULL::VARCHAR AS last_text")
            parts.append(f"SELECT '{name.replace('stg_', 'fact_')}' AS fact, '{out}' AS column_name, "
                         f"count({value}) AS filled, {ends} FROM lineitem")
        digest = f"('0x' || substr(md5(concat_ws('|', {', '.join(texts)})), 1, 8))::BIGINT"
        parts.append(f"SELECT '{name.replace('stg_', 'fact_')}' AS fact, 'whole rows' AS column_name, "
                     "count(*) AS filled, NULL::DOUBLE AS least, NULL::DOUBLE AS most, "
                     f"sum({digest})::VARCHAR AS first_text, NULL::VARCHAR AS last_text FROM lineitem")
    return " UNION ALL ".join(parts)


def _lookups() -> str:
    parts = []
    for spec in LOOKUPS.values():
        key, *others = [wanted for _, wanted in lookup_values(spec)]
        parts.append(f"SELECT '{spec.name}' AS lookup, {key} AS key, concat_ws('|', {', '.join(others)}) AS explained FROM part")
    return " UNION ALL ".join(parts)


def _decoded() -> str:
    parts = []
    for name, codes in CODE_MAP.items():
        joins, told = [], []
        for at, (_, lookup, key) in enumerate(codes):
            joins.append(f"LEFT JOIN sizes s{at} ON s{at}.p_size = (c_custkey * {at + 1}) % 60")
            told += [f"CASE WHEN s{at}.p_size IS NULL THEN '-' ELSE concat_ws(' ', '{out}', s{at}.name) END"
                     for _, out, _ in LOOKUPS[lookup].columns if out != key]
        parts.append(f"SELECT '{name}' AS table_name, c_custkey, concat_ws('|', {', '.join(told)}) AS decoded "
                     f"FROM customer {' '.join(joins)}")
    return "WITH sizes AS (SELECT p_size, max(p_name) AS name FROM part GROUP BY p_size) " + " UNION ALL ".join(parts)


ORACLES: dict[str, str] = {
    "scan_delimited": """
        SELECT c_custkey::INTEGER AS c_custkey, replace(c_name, '#', ', no ') AS c_name, c_nationkey,
               CAST(c_acctbal AS DECIMAL(18,2))::DOUBLE AS c_acctbal, c_mktsegment FROM customer""",
    "scan_line_breaks": """
        SELECT c_custkey::INTEGER AS c_custkey, CASE WHEN c_acctbal < 0 THEN c_mktsegment
            ELSE c_mktsegment || chr(10) || replace(c_name, '#', ' "no",' || chr(10) || chr(10)) END AS note,
            c_nationkey::INTEGER AS c_nationkey FROM customer""",
    "sniff_types": """
        WITH n AS (SELECT COUNT(*) AS filled, COUNT(*) FILTER (o_orderkey < 10000000) AS padded FROM orders)
        SELECT column_name, declared, sniffed, CASE column_name WHEN 'NOTHING' THEN 0 ELSE filled END AS filled,
            CASE column_name WHEN 'CODE' THEN padded ELSE 0 END AS coded
        FROM n CROSS JOIN (VALUES ('KEY', 'bigint', 'bigint'), ('PRICE', 'decimal(18,2)', 'decimal'),
            ('EXPONENT', NULL, 'double'), ('DAY', NULL, 'date'), ('STAMP', NULL, 'timestamp'),
            ('FLAG', NULL, 'boolean'), ('CODE', 'string', 'bigint'), ('MIXED', NULL, 'string'),
            ('NOTHING', NULL, NULL), ('PRIORITY', NULL, 'string')) AS t(column_name, declared, sniffed)""",
    "scan_rejected": """
        SELECT c_custkey || ',"' || replace(c_name, '#', ', no ') || '"' AS line
        FROM customer WHERE c_acctbal < 0""",
    "staging_audit": """
        SELECT 'customer' AS table_name, COUNT(*) AS kept_rows,
               COUNT(*) + COUNT(*) FILTER (c_acctbal < 0) AS raw_rows,
               ROUND(COUNT(*) * 100.0 / (COUNT(*) + COUNT(*) FILTER (c_acctbal < 0)), 2)::DOUBLE AS kept_percent
        FROM customer""",
    "lookup_normalize": """
        SELECT p_partkey::VARCHAR AS code, lpad(p_size::VARCHAR, 4, '0') AS size_code,
               trim(p_name) AS description,
               CASE WHEN p_type IN ('ECONOMY', 'MEDIUM', 'STANDARD') THEN TRUE
                    WHEN p_type IN ('LARGE', 'SMALL') THEN FALSE END AS is_flagged
        FROM part""",
    "typed_projection": """
        WITH t AS (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS m,
            CASE WHEN o_orderstatus = 'P' THEN 'n/a' WHEN o_orderpriority = '5-LOW' THEN '0.4999999'
                 WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '1.4999999999' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price
            FROM orders)
        SELECT o_orderkey::VARCHAR AS parcel_id, TRY_CAST(price AS INTEGER) AS whole,
               TRY_CAST(price AS DECIMAL(10,2))::DOUBLE AS amount, TRY_CAST(price AS DOUBLE) AS ratio,
               CASE WHEN m * 1000 < 100000000 THEN (m * 1000)::DOUBLE END AS capped,
               o_orderdate AS at,
               CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS flag
        FROM t""",
    "timestamp_text": "SELECT o_orderkey, o_orderdate AS at FROM orders",
    "table_profile": _PROFILE,
    "warehouse_roundtrip": "SELECT * FROM lineitem",
    "polygon_layer": """
        SELECT c_custkey::VARCHAR AS parcel_id, (700000 + c_custkey)::DOUBLE AS longitude,
               (1300000 + 10 * c_nationkey)::DOUBLE AS latitude FROM customer""",
    "key_decompose": """
        SELECT c_custkey, c_name, SUBSTRING(c_name, 1, 8) AS kind, SUBSTRING(c_name, 9, 1) AS mark,
               SUBSTRING(c_name, 10, 4) AS high, SUBSTRING(c_name, 14, 5) AS low FROM customer""",
    "mmyy_dates": """
        SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate
            WHEN o_orderstatus = 'P' OR o_orderpriority = '5-LOW' THEN NULL
            ELSE strptime(strftime(o_orderdate, '%m%y'), '%m%y') END AS last_insp_date
        FROM orders""",
    "recent_activity": f"""
        SELECT o_orderkey, COALESCE(total, 0)::DOUBLE AS recent_total, k IS NOT NULL AS has_recent
        FROM orders LEFT JOIN ({_RECENT}) ON k = o_orderkey""",
    "classify_rules": f"""
        WITH t AS (
            SELECT o_orderkey, lpad(CAST((o_orderkey * 7 + o_custkey) % 101 AS VARCHAR), 2, '0') AS uc,
                   CAST(o_totalprice AS DECIMAL(18,2)) AS tv,
                   CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 25000 END AS hx,
                   CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN NULL ELSE o_totalprice END AS xv,
                   COALESCE(total, 0) * 3 AS pv, k IS NOT NULL AS pf
            FROM orders LEFT JOIN ({_RECENT}) ON k = o_orderkey)
        SELECT o_orderkey, {_basic_stratum('uc', 'tv', '(tv / 2)', 'xv', 'hx', 'pv', 'pf')} AS stratum FROM t""",
    "enrich_left": """
        SELECT o_custkey AS custkey, o_orderkey, o_orderpriority, c_name, c_nationkey AS nationkey, n_name
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal >= 0
        LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "enrich_left_fanout": """
        SELECT c_custkey AS custkey, c_name, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey""",
    "star_decode": """
        SELECT c_custkey, n_name AS nation, r_name AS region FROM customer
        LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "stratum_collapse": """
        WITH held AS (SELECT c_nationkey AS n, SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS v FROM customer GROUP BY 1),
        shared AS (SELECT n, v, SUM(v) FILTER (n <= 20) OVER () AS whole FROM held)
        SELECT c_custkey, c_nationkey,
               CASE WHEN n <= 20 AND v < whole * 0.045 THEN 99 ELSE n END AS active_stratum
        FROM customer JOIN shared ON c_nationkey = n""",
    "cumulative_share": _CUMULATIVE,
    "cumulative_share_placed": _CUMULATIVE,
    "rank_in_stratum": _RANKED,
    "rank_in_stratum_placed": _RANKED,
    "value_groups": _VALUE_GROUPS,
    "value_groups_placed": _VALUE_GROUPS,
    "value_groups_all": _VALUE_GROUPS_ALL,
    "value_groups_all_placed": _VALUE_GROUPS_ALL,
    "sales_ratio": f"""
        SELECT l_orderkey, l_linenumber, CASE WHEN sp > 0 THEN ROUND(av::DOUBLE / sp::DOUBLE, 9) END AS ratio
        FROM ({_SALES})""",
    "ratio_cod": _study("p_brand", measures="ROUND(100 * AVG(ABS(r - med)) / ANY_VALUE(med), 6) AS cod"),
    "ratio_prd": _study(
        "l_returnflag", measures="ROUND(AVG(r) / (SUM(av)::DOUBLE / SUM(sp)::DOUBLE), 6) AS prd"
    ),
    "ratio_study": _study("p_brand"),
    "ratio_study_placed": _study("p_brand"),
    "ratio_study_all": _study_all(),
    "ratio_study_all_placed": _study_all(),
    "ratio_study_filtered": _study("l_returnflag", """
        l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AND
        p_type IN (SELECT p_type FROM part GROUP BY p_type
                   HAVING AVG(p_retailprice) > (SELECT AVG(p_retailprice) FROM part))"""),
    "fanout_audit": """
        WITH n AS (SELECT (SELECT COUNT(*) FROM orders) AS b,
            (SELECT COUNT(*) FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey) AS o)
        SELECT 'orders_with_lines' AS table_name, b AS base_rows, o AS output_rows, o - b AS extra_rows,
               ROUND((o - b) * 100.0 / b, 2)::DOUBLE AS extra_percent FROM n""",
    "duplicate_keys": "SELECT o_custkey, COUNT(*) AS row_count FROM orders GROUP BY 1 HAVING COUNT(*) > 1",
    "cluster_features": """
        SELECT o_orderkey AS key, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS value,
               CASE WHEN o_orderstatus = 'F' THEN 'Unknown' ELSE o_orderpriority END AS quality,
               o_orderpriority[1:2] AS prefix, COALESCE(SUM(l_quantity), 0)::DOUBLE AS area
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""",
    "one_hot": f"SELECT p_partkey, {_ONE_HOT} FROM part",
    "standardize": """
        WITH s AS (SELECT AVG(p_retailprice) AS a1, STDDEV_POP(p_retailprice) AS d1,
                          AVG(p_size) AS a2, STDDEV_POP(p_size) AS d2 FROM part)
        SELECT p_partkey, ROUND((p_retailprice - a1) / d1, 6) AS p_retailprice,
               ROUND((p_size - a2) / d2, 6) AS p_size FROM part, s""",
    "elbow_select": """
        WITH v AS (SELECT CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS HUGEINT) AS v FROM lineitem),
        e AS (SELECT MIN(v) AS lo, MAX(v) AS hi FROM v),
        binned AS (
            SELECT k, FLOOR((v - lo)::DOUBLE * k / (hi - lo + 1)::DOUBLE) AS bin, COUNT(*) AS n,
                   SUM(v) AS s, SUM(v * v) AS s2
            FROM v, e, UNNEST(range(2, 11)) AS r(k) GROUP BY ALL),
        sweep AS (SELECT k::INTEGER AS k, SUM((n * s2 - s * s)::DOUBLE / n) / 1e12 AS wcss FROM binned GROUP BY 1),
        ends AS (SELECT MIN(k) AS x1, MAX(k) AS x2, arg_min(wcss, k) AS y1, arg_max(wcss, k) AS y2 FROM sweep)
        SELECT k, ROUND(wcss, 4) AS wcss,
               ROUND(ABS((x2 - x1) * (y1 - wcss) - (x1 - k) * (y2 - y1))
                     / SQRT((x2 - x1) ** 2 + (y2 - y1) ** 2), 5) AS distance
        FROM sweep, ends""",
    "kmeans_properties": """
        SELECT k::INTEGER AS k, (SELECT COUNT(*) FROM part) AS assigned, k::BIGINT AS clusters,
               TRUE AS cost_matches, TRUE AS labels_match FROM range(2, 11) AS ks(k)""",
    "cluster_join_back": """
        SELECT lpad(o_orderkey::VARCHAR, 18, '0') AS parcel_id, 1::BIGINT AS labels, TRUE AS label_known,
               TRUE AS k_in_range, 4::BIGINT AS tried FROM orders""",
    "versioned_tables": """
        SELECT o_orderkey, (2 * CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS price,
               (SELECT COUNT(*) FROM orders)::INTEGER AS first_rows,
               (SELECT COUNT(*) FROM orders WHERE o_orderkey % 2 = 0)::INTEGER AS half_rows,
               (SELECT COUNT(*) FROM orders WHERE o_orderkey % 2 = 0)::INTEGER AS last_rows, 2::BIGINT AS collected
        FROM orders WHERE o_orderkey % 2 = 0""",
    "run_ledger": """
        SELECT run_id, 'customer' AS table_name, COUNT(*) AS kept_rows,
               COUNT(*) + COUNT(*) FILTER (c_acctbal < 0) AS raw_rows, COUNT(*) FILTER (c_acctbal < 0) AS rejected_rows,
               TRUE AS timed
        FROM customer CROSS JOIN (VALUES ('2026-01'), ('2026-02')) AS runs(run_id) GROUP BY run_id""",
    "parcel_cluster_properties": """
        SELECT (SELECT COUNT(*) FROM orders) AS parcels, (SELECT COUNT(*) FROM orders) AS keys,
               TRUE AS k_in_range, TRUE AS labels_match, TRUE AS all_used""",
    "one_hot_sparse": """
        SELECT p_partkey, 1 + CASE WHEN p_type = (SELECT MIN(p_type) FROM part) THEN 0 ELSE 1 END
               + CASE WHEN p_brand = (SELECT MIN(p_brand) FROM part) THEN 0 ELSE 1 END AS stored,
               (SELECT COUNT(DISTINCT p_type) + COUNT(DISTINCT p_brand) - 1 FROM part)::INTEGER AS width
        FROM part""",
    "polygon_centroid": """
        WITH c AS (SELECT *, 700000.0::DOUBLE + c_custkey AS x, 1300000.0::DOUBLE + 10 * c_nationkey AS y,
                          100.0::DOUBLE + c_nationkey AS s FROM customer)
        SELECT c_custkey,
               ROUND(CASE WHEN c_acctbal < 0 THEN x + 40 ELSE x + (s * s * s / 2 - 2500) / (s * s - 100) END, 4) AS x,
               ROUND(CASE WHEN c_acctbal < 0 THEN y + 20 ELSE y + (s * s * s / 2 - 2500) / (s * s - 100) END, 4) AS y
        FROM c""",
    "project_coordinates": """
        SELECT lpad(CAST(o_orderkey AS VARCHAR), 18, '0') AS parcel_id,
               ROUND((o_orderkey % 90001) / 100000 - 82.05, 6)::DOUBLE AS longitude,
               ROUND((o_custkey % 70001) / 100000 + 27.65, 6)::DOUBLE AS latitude
        FROM orders""",
    "dim_build": _dim(),
    "dim_build_placed": _dim(),
    "warehouse_build": _dim(),
    "warehouse_facts": _facts(),
    "warehouse_lookups": _lookups(),
    "star_decode_all": _decoded(),
}

"""Left joins that stay balanced, and the join of per-group tables back to rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.shared import stage

HOT_ROWS = 5_000_000
_SAMPLE = 0.01


def attach(df: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Add the columns of a per-group table (one row per key) to every row; NULL keys match.

    No broadcast is asked for: pass a staged table, and Spark broadcasts it when its file size is
    under ``spark.sql.autoBroadcastJoinThreshold`` and merges otherwise. Without keys ``groups`` is a
    single row, whose values are attached to every row.
    """
    if not keys:
        if not groups.columns:
            return df
        held = df.withColumn("_group", groups.select(F.struct(*groups.columns)).scalar())
        return held.select(*df.columns, "_group.*")
    right = groups.withColumnsRenamed({key: f"_group_{key}" for key in keys})
    match = reduce(
        lambda a, b: a & b, (F.col(key).eqNullSafe(F.col(f"_group_{key}")) for key in keys)
    )
    return df.join(right, match, "left").drop(*[f"_group_{key}" for key in keys])


def hot_keys(
    df: DataFrame, key: str, hot_rows: int = HOT_ROWS, fraction: float = _SAMPLE
) -> DataFrame:
    """A staged table of the keys with about ``hot_rows`` rows or more, judged from a sample.

    It may hold a null. It only steers how rows are joined, so it may be short of some keys.
    """
    return hot_keys_of({"all": df}, key, hot_rows, fraction).get("all", df.select(key).limit(0))


def hot_keys_of(
    tables: dict[str, DataFrame], key: str, hot_rows: int = HOT_ROWS, fraction: float = _SAMPLE
) -> dict[str, DataFrame]:
    """The hot keys of several tables in one pass, for those tables that have any."""
    sampled = [
        df.select(F.lit(name).alias("_of"), key).sample(fraction, 5) for name, df in tables.items()
    ]
    counts = reduce(DataFrame.unionAll, sampled).groupBy("_of", key).agg(F.count(F.lit(1)).alias("_n"))
    hot = stage(counts.filter(F.col("_n") >= hot_rows * fraction).select("_of", key), "hot-keys")
    found = {row["_of"] for row in hot.select("_of").distinct().collect()}
    return {name: hot.filter(F.col("_of") == name).select(key) for name in tables if name in found}


def left_enrich(
    df: DataFrame,
    other: DataFrame,
    key: str,
    hot_rows: int = HOT_ROWS,
    fraction: float = _SAMPLE,
    known: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """``df`` left joined with ``other`` on ``key``; a repeated key in ``other`` repeats the row.

    Spark splits a skewed left side of a left join by itself, but never the right side. So keys that
    are hot in ``other`` go through an inner join, where either side may be split: they do occur in
    ``other``, so the result is the same. ``known`` may hold those keys, under ``other``, from a pass
    made before; without an entry the join is plain.
    """
    found = hot_keys_of({"other": other}, key, hot_rows, fraction) if known is None else known
    if "other" not in found:
        return df.join(other, key, "left")
    hot = found["other"].filter(F.col(key).isNotNull())
    cold = df.join(hot, key, "left_anti").join(other.join(hot, key, "left_anti"), key, "left")
    return cold.unionByName(df.join(hot, key, "left_semi").join(other.join(hot, key, "left_semi"), key))

"""Types of undeclared columns: what all their values can be read as.

Every value has a set of types it can be read as, a bit for each. The types of a column are those that all its values
share, so sets are merged by AND, in any order and any number of parts: one aggregate over all lines, however many columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Types from the narrowest to the widest of each chain, and the shape of their values. A value of a
# narrow type is one of the wider types of its chain too.
_NUMBER = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)"
_DAY = r"([0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])|(0?[1-9]|1[0-2])/(0?[1-9]|[12][0-9]|3[01])/[0-9]{4})"
SHAPES = {
    "boolean": r"(?i)(true|false)",
    "bigint": r"[+-]?[0-9]{1,18}",
    "decimal": _NUMBER,
    "double": rf"{_NUMBER}([eE][+-]?[0-9]+)?",
    "date": _DAY,
    "timestamp": rf"{_DAY}([ T][0-9]{{1,2}}:[0-9]{{2}}(:[0-9]{{2}}(\.[0-9]+)?)?)?",
}


def type_set(value: Column) -> Column:
    """The types a trimmed text can be read as, a bit each; none for text of no shape, NULL for NULL and blank."""
    text = F.trim(value)
    bits = [F.when(text.rlike(f"^({shape})$"), F.lit(1 << at)).otherwise(F.lit(0)) for at, shape in enumerate(SHAPES.values())]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return F.when(text != "", total)


def _narrowest(types: Column) -> Column:
    found = F.when(types.isNull(), F.lit(None).cast("string"))
    for at, name in enumerate(SHAPES):
        found = found.when(types.bitwiseAND(1 << at) != 0, F.lit(name))
    return found.otherwise("string")


def sniff_types(df: DataFrame, declared: dict[str, str] | None = None) -> DataFrame:
    """(column_name, declared, sniffed, filled, coded) of each text column, over all rows.

    ``sniffed`` is the narrowest type that all filled values share, ``string`` without one, NULL for a column without
    values. ``coded`` counts whole numbers that begin with a zero and have more digits, which a number would lose: such
    a column is better kept as text. ``declared`` holds the declared types by column name, without regard to case.
    """
    known = {name.lower(): kind for name, kind in (declared or {}).items()}
    names = df.columns
    held = df.select(*[F.col(f"`{name}`").alias(f"c{at}") for at, name in enumerate(names)])
    measures = []
    for at in range(len(names)):
        value = F.col(f"c{at}")
        measures += [
            F.bit_and(type_set(value)).alias(f"t{at}"), F.count_if(F.trim(value) != "").alias(f"n{at}"),
            F.count_if(F.trim(value).rlike("^0[0-9]+$")).alias(f"z{at}"),
        ]
    rows = [F.struct(
        F.lit(name).alias("column_name"), F.lit(known.get(name.lower())).cast("string").alias("declared"),
        _narrowest(F.col(f"t{at}")).alias("sniffed"), F.col(f"n{at}").alias("filled"), F.col(f"z{at}").alias("coded"),
    ) for at, name in enumerate(names)]
    return held.agg(*measures).select(F.inline(F.array(*rows)))

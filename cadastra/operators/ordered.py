"""Running totals and ranks within groups that may each be far too large for one task.

A window over a handful of groups runs in a handful of tasks. Here the rows go through one range exchange by
(group, value, tie) instead, into tasks that sort them and cut them into parts of bounded size as they go. A part is summed
by itself as it is written; a small table of what each part holds of each group gives the totals and rows before it, and
joins what a cut has split. Tasks are far fewer than small parts, so what they send to the driver stays small.

* A part's rows are ordered by a random number last, so a key of any number of copies is spread over parts.
  What follows of a part's last key in later parts, and where its first value begins in earlier ones, come from the
  small table.
* How even the parts are affects speed only, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cadastra.operators.joins import attach
from cadastra.shared import share_package, stage

# A group up to this size is sorted by one task; beyond it the rows go into parts.
PLAIN_ROWS = 1_000_000
ROWS_PER_PLACE = 200_000
# A part ends at this many bytes, however few its rows: it is held in memory.
PLACE_BYTES = 16 << 20
# Parts whose starts are a small table; beyond it parts grow with the rows.
MAX_PLACES = 262_144
# A part is a task up to so many; more parts share tasks of so many rows.
FEW_TASKS, ROWS_PER_TASK = 200, 200_000

_PART, _SUM, _AT, _HEAD, _TAIL, _HEAD_VALUE = "_part", "_part_sum", "_part_at", "_head", "_tail", "_head_value"
_NUMBER, _SALT = "_number", "_salt"
_LIMB = (1 << 32) - 1


def largest_group(df: DataFrame, by: list[str]) -> int:
    """Rows of the largest group."""
    if not by:
        return df.count()
    row = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()
    return row[0] or 0


def choose_strategy(df: DataFrame, by: list[str], strategy: str, plain_rows: int) -> str:
    if strategy not in ("auto", "plain", "placed"):
        raise ValueError("strategy is 'auto', 'plain' or 'placed'")
    if strategy == "auto":
        return "plain" if largest_group(df, by) <= plain_rows else "placed"
    return strategy


def sort_key(columns: list[str]) -> Column:
    """A comparable struct of the columns, ascending with NULLs last."""
    fields = []
    for number, name in enumerate(columns):
        fields += [F.col(name).isNull().alias(f"n{number}"), F.col(name).alias(f"k{number}")]
    return F.struct(*fields)


def _part_rows(rows: int, rows_per_place: int, max_places: int) -> int:
    return max(1, rows_per_place, -(-rows // max_places))


def _task_count(rows: int, part_rows: int) -> int:
    return max(1, min(-(-rows // part_rows), max(FEW_TASKS, -(-rows // ROWS_PER_TASK))))


def _cut(batches: Iterator[pa.RecordBatch], part_rows: int, part_bytes: int) -> Iterator[pa.Table]:
    """Consecutive parts of the rows: of so many rows each, or fewer that have so many bytes."""
    held, rows, size = [], 0, 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            held.append(batch.slice(at, part_rows - rows))
            at, rows, size = at + held[-1].num_rows, rows + held[-1].num_rows, size + held[-1].nbytes
            if rows >= part_rows or size >= part_bytes:
                yield pa.Table.from_batches(held)
                held, rows, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _changes(columns: list[pa.Array], rows: int) -> np.ndarray:
    """Whether each row but the first differs from the one before in any column; NULLs equal NULLs."""
    found = np.zeros(max(rows - 1, 0), bool)
    for column in columns if rows > 1 else ():
        before, after = column.slice(0, rows - 1), column.slice(1)
        differs = pc.fill_null(pc.not_equal(before, after), False)
        if pa.types.is_floating(column.type):
            nans = pc.and_(pc.fill_null(pc.is_nan(before), False), pc.fill_null(pc.is_nan(after), False))
            differs = pc.and_not(differs, nans)
        differs = pc.or_(differs, pc.xor(before.is_null(), after.is_null()))
        found |= differs.to_numpy(zero_copy_only=False)
    return found


def _limbs(numbers: pa.Array) -> list[np.ndarray]:
    """The 128-bit numbers as four 32-bit limbs, lowest first, the last one signed; 0 for NULL."""
    words = np.frombuffer(numbers.buffers()[1], np.int64)[2 * numbers.offset:2 * (numbers.offset + len(numbers))]
    words = np.where(numbers.is_null().to_numpy(zero_copy_only=False)[:, None], 0, words.reshape(-1, 2))
    low, high = words[:, 0], words[:, 1]
    return [low & _LIMB, (low >> 32) & _LIMB, high & _LIMB, high >> 32]


def _decimals(limbs: list[np.ndarray], known: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Sums of limbs as decimals, NULL where not known."""
    carry, words = np.zeros(len(known), np.int64), []
    for limb in limbs:
        total = limb + carry
        words.append(total & _LIMB)
        carry = total >> 32
    pairs = np.stack([words[0] | words[1] << 32, words[2] | words[3] << 32], axis=1)
    valid = pa.py_buffer(np.packbits(known, bitorder="little").tobytes())
    return pa.Array.from_buffers(kind, len(known), [valid, pa.py_buffer(np.ascontiguousarray(pairs).tobytes())])


def _summed(part: pa.Table, by: list[str], value: str, tie: str, number: int) -> pa.Table:
    """One sorted part: per row the sum up to its last peer and the rank, both within this part and group."""
    rows = part.num_rows
    column = {name: part.column(name).combine_chunks() for name in dict.fromkeys([*by, value, tie, _NUMBER])}
    new_group = _changes([column[b] for b in by], rows)
    new_value = new_group | _changes([column[value]], rows)
    new_key = new_value | _changes([column[tie]], rows)

    def run_of(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last row of the run that each row is in."""
        starts = np.concatenate([[0], np.flatnonzero(new) + 1])
        run = np.concatenate([[0], np.cumsum(new)])
        return starts[run], np.append(starts[1:], rows)[run] - 1

    (group, group_last), (first, _), (key, last) = run_of(new_group), run_of(new_value), run_of(new_key)

    def through(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[last + 1] - total[group]

    numbers = column[_NUMBER]
    known = through(numbers.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)) > 0
    made = {
        _PART: pa.array(np.full(rows, number, np.int64)),
        _SUM: _decimals([through(limb) for limb in _limbs(numbers)], known, numbers.type),
        _AT: pa.array(first - group + 1),
        _HEAD: pa.array(key == group), _TAIL: pa.array(last == group_last), _HEAD_VALUE: pa.array(first == group),
    }
    kept = part.drop_columns([_NUMBER])
    for name, values in made.items():
        kept = kept.append_column(name, values)
    return kept


def _parts(
    source: DataFrame, by: list[str], value: str, tie: str, number: Column, tasks: int, part_rows: int = ROWS_PER_PLACE,
) -> DataFrame:
    """The rows in order, part by part, each with its sum and rank inside its part and group."""
    part_bytes = PLACE_BYTES
    order = [*[F.col(b).asc() for b in by], F.col(value).asc_nulls_last(), F.col(tie).asc_nulls_last()]
    # Reproducible in a repeated task, since the input is a scan of files.
    salted = source.withColumns({_NUMBER: number, _SALT: F.rand(11)})
    dealt = salted.repartitionByRange(tasks, *order, F.col(_SALT)).sortWithinPartitions(*order).drop(_SALT)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for at, part in enumerate(_cut(batches, part_rows, part_bytes)):
            yield from _summed(part, by, value, tie, first + at).to_batches()

    flags = [T.StructField(name, T.BooleanType()) for name in (_HEAD, _TAIL, _HEAD_VALUE)]
    schema = T.StructType([
        *source.schema.fields, T.StructField(_PART, T.LongType()),
        T.StructField(_SUM, dealt.schema[_NUMBER].dataType), T.StructField(_AT, T.LongType()), *flags,
    ])
    return stage(dealt.mapInArrow(sums, schema), "parts")


def _part_table(parts: DataFrame, by: list[str], value: str, tie: str) -> DataFrame:
    """Per group and part: sum and rows before it, what follows of its last key, the rank of its first value."""

    def at(flag: str, names: list[str]) -> Column:
        return F.max(F.when(F.col(flag), sort_key(names)))

    totals = stage(parts.groupBy(*by, _PART).agg(
        F.count(F.lit(1)).alias("_rows"), F.max(F.when(F.col(_TAIL), F.col(_SUM))).alias("_amount"),
        F.max(F.when(F.col(_HEAD), F.col(_SUM))).alias("_head_amount"), F.max(_AT).alias("_last_at"),
        at(_HEAD, [value, tie]).alias("_first_key"), at(_TAIL, [value, tie]).alias("_last_key"),
        at(_HEAD, [value]).alias("_first_value"), at(_TAIL, [value]).alias("_last_value"),
    ), "part-totals")
    before = Window.partitionBy(*by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*by, "_first_key").orderBy(_PART).rowsBetween(Window.unboundedPreceding, 0)
    running = totals.withColumns({
        "_rows_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)),
        "_amount_before": F.sum("_amount").over(before),
        "_head_upto": F.sum("_head_amount").over(upto),
    })
    heads = totals.groupBy(*by, F.col("_first_key").alias("_last_key")).agg(F.sum("_head_amount").alias("_heads"))
    starts = running.groupBy(*by, F.col("_last_value").alias("_first_value")).agg(
        F.min(F.col("_rows_before") + F.col("_last_at")).alias("_earlier"))
    joined = attach(attach(running, heads, [*by, "_last_key"]), starts, [*by, "_first_value"])
    own = F.when(F.col("_first_key") == F.col("_last_key"), F.coalesce("_head_upto", F.lit(0))).otherwise(F.lit(0))
    return stage(joined.select(
        *by, _PART, "_rows_before", "_amount_before",
        (F.coalesce("_heads", F.lit(0)) - own).alias("_following"),
        F.least("_earlier", F.col("_rows_before") + 1).alias("_first_rank"),
    ), "part-starts")


def _check_exact(df: DataFrame, value: str) -> None:
    kind = df.schema[value].dataType
    if not isinstance(kind, (T.IntegralType, T.DecimalType)):
        raise ValueError(f"{value} is {kind.simpleString()}: cast it to decimal, sums must be exact")


def ordered_totals(
    df: DataFrame,
    by: list[str],
    value: str,
    tie: str,
    running: str = "running_total",
    rank: str = "value_rank",
    strategy: str = "auto",
    plain_rows: int = PLAIN_ROWS,
    rows_per_place: int = ROWS_PER_PLACE,
    max_places: int = MAX_PLACES,
    staged: bool = False,
) -> DataFrame:
    """Add the running sum of ``value`` in (value, tie) order and the rank of ``value`` per group.

    NULLs come last; rows equal in value and tie are peers and share one running sum; ranks share
    ties and leave gaps. ``staged=True`` says that ``df`` is already a cheap scan of written files,
    with no shuffle since.
    """
    _check_exact(df, value)
    number = F.col(value).cast("decimal(20,0)") if isinstance(
        df.schema[value].dataType, T.IntegralType
    ) else F.col(value)
    scale = getattr(df.schema[value].dataType, "scale", 0)
    sum_type = T.DecimalType(38, scale)
    nulls_last = [F.col(value).asc_nulls_last(), F.col(tie).asc_nulls_last()]
    if choose_strategy(df, by, strategy, plain_rows) == "plain":
        group = Window.partitionBy(*by)
        return df.withColumns(
            {
                running: F.sum(number).over(group.orderBy(*nulls_last)).cast(sum_type),
                rank: F.rank().over(group.orderBy(nulls_last[0])).cast("bigint"),
            }
        )

    share_package(df.sparkSession)
    source = df if staged else stage(df)
    rows = source.count()
    part_rows = _part_rows(rows, rows_per_place, max_places)
    parts = _parts(source, by, value, tie, number.cast(sum_type), _task_count(rows, part_rows), part_rows)
    found = attach(parts, _part_table(parts, by, value, tie), [*by, _PART])
    zero = F.lit(0).cast(sum_type)
    total = F.when(
        F.col("_amount_before").isNotNull() | F.col(_SUM).isNotNull(),
        F.coalesce(F.col("_amount_before"), zero) + F.coalesce(F.col(_SUM), zero)
        + F.when(F.col(_TAIL), F.col("_following")).otherwise(zero),
    )
    position = F.when(F.col(_HEAD_VALUE), F.col("_first_rank")).otherwise(F.col("_rows_before") + F.col(_AT))
    return found.select(
        *df.columns, total.cast(sum_type).alias(running), position.cast("bigint").alias(rank)
    )

"""k-means for many k at once: one scan per iteration moves the centres of every k.

A scan sums, per centre of every k, the rows nearest to it; the partial sums of a task are one number per centre
and feature, added up before the driver sees them. What the driver holds is the centres and those sums: their size
is that of the models, whatever the rows. Starting centres come from a bounded sample; they steer how many scans
are needed, and each k is then moved over all rows until it rests.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.shared import share_package, stage

MAX_SCANS = 300
TOLERANCE = 1e-4
# Rows that the starting centres are chosen from.
SAMPLE_ROWS = 20_000
_ROWS, _COST = -1, -2


@dataclass(frozen=True)
class Points:
    """Sparse rows: row ``i`` has ``values[at]`` at the features ``index[at]`` for which ``row[at] == i``."""

    rows: int
    row: np.ndarray
    index: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, index: pa.Array, values: pa.Array) -> Points:
        sizes = np.diff(index.offsets.to_numpy())
        return cls(
            len(index), np.repeat(np.arange(len(index)), sizes), index.flatten().to_numpy(zero_copy_only=False),
            values.flatten().to_numpy(zero_copy_only=False),
        )

    def squares(self) -> np.ndarray:
        return np.bincount(self.row, self.values**2, self.rows)

    def apart(self, centres: np.ndarray) -> np.ndarray:
        """Squared distances of every row to every centre."""
        found = np.empty((self.rows, len(centres)))
        square = self.squares()
        for at, centre in enumerate(centres):
            product = np.bincount(self.row, self.values * centre[self.index], self.rows)
            found[:, at] = square - 2 * product + centre @ centre
        return np.maximum(found, 0, out=found)

    def sums(self, of: np.ndarray, groups: int, width: int) -> np.ndarray:
        """The sum of the rows of each group, a row of features per group."""
        return np.bincount(of[self.row] * width + self.index, self.values, groups * width).reshape(groups, width)

    def dense(self, at: int, width: int) -> np.ndarray:
        own = self.row == at
        return np.bincount(self.index[own], self.values[own], width)


def _scan(points: Points, models: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """Per k: sums and rows of each centre, and the cost of all rows."""
    found, width = {}, next(iter(models.values())).shape[1]
    every = points.apart(np.concatenate(list(models.values())))
    first = 0
    for k, centres in models.items():
        own = every[:, first:first + len(centres)]
        first += len(centres)
        nearest = own.argmin(axis=1)
        found[k] = (
            points.sums(nearest, len(centres), width), np.bincount(nearest, minlength=len(centres)),
            float(own[np.arange(points.rows), nearest].sum()),
        )
    return found


def _scan_all(points: DataFrame, models: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """The same over all rows of a table of (index, value) arrays."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            own = _scan(Points.of(batch.column(0), batch.column(1)), models)
            total = own if total is None else {
                k: tuple(a + b for a, b in zip(total[k], own[k])) for k in models}
        for number, (sums, rows, cost) in enumerate((total or {}).values()):
            centre, feature = np.nonzero(sums)
            held = np.flatnonzero(rows)
            columns = (
                np.full(len(centre) + len(held) + 1, number), np.concatenate([centre, held, [0]]),
                np.concatenate([feature, np.full(len(held), _ROWS), [_COST]]),
                np.concatenate([sums[centre, feature], rows[held], [cost]]),
            )
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["model", "centre", "feature", "amount"])

    added = points.mapInArrow(partial, "model int, centre int, feature int, amount double").groupBy(
        "model", "centre", "feature").agg(F.sum("amount").alias("amount")).toArrow()
    model, centre, feature, amount = (added.column(c).to_numpy() for c in added.column_names)
    found = {}
    for number, (k, centres) in enumerate(models.items()):
        sums, rows = np.zeros(centres.shape), np.zeros(len(centres))
        own = model == number
        moved, counted, cost = own & (feature >= 0), own & (feature == _ROWS), own & (feature == _COST)
        sums[centre[moved], feature[moved]] = amount[moved]
        rows[centre[counted]] = amount[counted]
        found[k] = sums, rows, float(amount[cost].sum())
    return found


def _moved(centres: np.ndarray, sums: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Means of the rows of each centre; a centre without rows stays where it is."""
    return np.where(rows[:, None] > 0, sums / np.maximum(rows, 1)[:, None], centres)


def _rested(before: np.ndarray, after: np.ndarray, tolerance: float) -> bool:
    return bool((((after - before) ** 2).sum(axis=1) <= tolerance**2).all())


def _starts(sample: Points, ks: list[int], width: int, seed: int) -> dict[int, np.ndarray]:
    """Starting centres of every k, moved over the sample until they rest.

    Rows are drawn by their squared distance to the centres so far, the best of a few draws each time; the first
    k of one such row of centres start k. Fewer, where the sample has fewer distinct rows.
    """
    rng = np.random.default_rng(seed)
    chosen = [sample.dense(int(rng.integers(sample.rows)), width)]
    apart = sample.apart(np.array(chosen))[:, 0]
    while len(chosen) < max(ks) and apart.max() > 1e-12 * max(1.0, float(sample.squares().max())):
        drawn = rng.choice(sample.rows, 2 + len(chosen).bit_length(), p=apart / apart.sum())
        tried = np.array([sample.dense(int(at), width) for at in drawn])
        left = np.minimum(apart[:, None], sample.apart(tried))
        best = int(left.sum(axis=0).argmin())
        chosen.append(tried[best])
        apart = left[:, best]
    models = {k: np.array(chosen[:k]) for k in ks}
    open_, rested = dict(models), {}
    for _ in range(MAX_SCANS):
        if not open_:
            break
        for k, (sums, rows, _) in _scan(sample, open_).items():
            after = _moved(open_[k], sums, rows)
            (rested if _rested(open_[k], after, TOLERANCE) else open_)[k] = after
        open_ = {k: centres for k, centres in open_.items() if k not in rested}
    return {k: {**open_, **rested}[k] for k in ks}


def sparse_points(vectors: DataFrame, features: str = "features") -> tuple[Column, Column]:
    """Places and values of a vector column, dense or sparse."""
    vector = F.unwrap_udt(features)
    every = F.transform(vector["values"], lambda _, at: at)
    return F.coalesce(vector["indices"], every), vector["values"]


@dataclass(frozen=True)
class KMeansCentres:
    """A fitted model: its centres, and its cost over the rows it was fitted on."""

    centres: np.ndarray
    cost: float

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def transform(self, vectors: DataFrame) -> DataFrame:
        """The rows with ``prediction``, the number of the nearest centre, the first of equals."""
        share_package(vectors.sparkSession)
        centres = self.centres

        @F.arrow_udf("int")
        def nearest(index: pa.Array, values: pa.Array) -> pa.Array:
            return pa.array(Points.of(index, values).apart(centres).argmin(axis=1), pa.int32())

        return vectors.withColumn("prediction", nearest(*sparse_points(vectors)))


def fit_many(vectors: DataFrame, ks, seed: int, sample_rows: int = SAMPLE_ROWS, max_scans: int = MAX_SCANS,
             tolerance: float = TOLERANCE) -> dict[int, KMeansCentres]:
    """A model per k over the column ``features``, in as many scans as the slowest k needs.

    A k rests when no centre moves farther than ``tolerance``; its cost is that of the centres it returns. No rows
    give no models.
    """
    share_package(vectors.sparkSession)
    places, values = sparse_points(vectors)
    size = F.coalesce(F.unwrap_udt("features")["size"], F.size(values))
    points = stage(vectors.select(places.alias("index"), values.alias("value"), size.alias("size")), "points")
    total, width = points.agg(F.count(F.lit(1)), F.max("size")).first()
    points, ks = points.drop("size"), list(ks)
    if not total or not ks:
        return {}
    taken = points.sample(min(1.0, 1.2 * sample_rows / total), 7).limit(sample_rows).toArrow().combine_chunks()
    if not taken.num_rows:
        taken = points.limit(sample_rows).toArrow().combine_chunks()
    sample = Points.of(*[column.combine_chunks() for column in taken.columns])
    open_, found = _starts(sample, ks, width, seed), {}
    for scan in range(max_scans):
        for k, (sums, rows, cost) in _scan_all(points, open_).items():
            after = _moved(open_[k], sums, rows)
            if _rested(open_[k], after, tolerance) or scan == max_scans - 1:
                found[k] = KMeansCentres(open_[k], cost)
            else:
                open_[k] = after
        open_ = {k: centres for k, centres in open_.items() if k not in found}
        if not open_:
            break
    return {k: found[k] for k in ks}

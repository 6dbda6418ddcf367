"""Whitening of embeddings by a polarisation covariance.

Entries are put on an integer grid, so all sums are exact. Over the distinct vectors (the fit list) tasks add up the
squared centred values of every dimension and of the sum of every pair of dimensions. As
var(a + b) = var(a) + var(b) + 2 cov(a, b), differences of these variances give all cross-covariances,
and ``eigh`` of the matrix gives the components. Values are centred by the whole part of the mean before they are
squared; what is left of the mean, a sum below the number of rows, is taken off exactly afterwards.

The driver and every task hold one number for each pair of dimensions, whatever the number of rows. Copies of a
vector are reduced in the tasks that read them.

Nulls and edge cases: a vector that is null, empty, or holds a null or non-finite entry is dropped, and so is one whose length is
not the commonest (of equally common ones the greatest). Entries on the grid beyond 2^50 either way count as 2^50. Repeated
rows and null ids stay rows of the result but count once in the fit. A component without variance (a constant
table, fewer vectors than dimensions) has null ``whitened``. ``deviation`` is null where it exceeds 64 bits.
Components of equal variance come in the order eigh gives. An empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import stored

GRID, SHIFT = 64, 1_000_000
COMPONENTS = 16
_LARGEST = float(1 << 50)
_BLOCK = 4096
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """What a fit learns: counts and sums are exact; ``vectors`` has one column a component."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    variances: np.ndarray
    vectors: np.ndarray
    identity_error: float | None

    @property
    def scales(self) -> np.ndarray:
        """What turns a centred vector into whitened components; NaN for components without variance."""
        least = self.variances.max(initial=0) * len(self.variances) * np.finfo(float).eps
        used = self.variances[:self.vectors.shape[1]]
        return self.vectors / np.sqrt(np.where(used > least, used, np.nan))


def on_grid(embeddings: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x``, the vector on the integer grid, of the rows that can be used."""
    entries = F.col(column).cast("array<double>")
    usable = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = embeddings.select(F.col(id_column).alias("vec_id"), entries.alias("entries")).where(
        F.col(column).isNotNull() & usable & (F.size(entries) > 0))
    common = rows.groupBy(F.size("entries").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("entries") == (common[0]["d"] if common else 0)).select("vec_id", F.transform(
        "entries", lambda c: F.floor(F.greatest(F.least(c * GRID, F.lit(_LARGEST)), F.lit(-_LARGEST))) + SHIFT).alias("x"))


def _matrices(batches: Iterable[pa.RecordBatch], column: str = "x") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for part in (batch.slice(i, _BLOCK) for i in range(0, batch.num_rows, _BLOCK)):
            flat = part.column(part.schema.get_field_index(column)).flatten()
            yield part, flat.to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def _added(rows: DataFrame, block_totals) -> list[int]:
    """Exact totals over all rows of what ``block_totals`` gives for a block of them; empty without rows.

    A task hands on one number a place, so the shuffle and the driver hold as many numbers as the result.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = None
        for _, x in _matrices(batches):
            found = block_totals(x)
            totals = found if totals is None else [a + b for a, b in zip(totals, found)]
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(totals)), pa.int32()), pa.array(map(Decimal, totals), pa.decimal128(38, 0))],
                names=["place", "total"])

    found = rows.mapInArrow(run, "place int, total decimal(38,0)").groupBy("place").agg(F.sum("total").alias("total"))
    return [int(r["total"]) for r in sorted(found.collect(), key=lambda r: r["place"])]


def _exact(x: np.ndarray, squares: int = 1) -> np.ndarray:
    """``x`` as int64 if sums over it (or of squares of pair sums) fit that, else as Python integers."""
    most = int(np.abs(x).max(initial=0)) * squares
    return x if (most ** squares) * max(x.shape[0], 1) < _LONG else x.astype(object)


def _sums(x: np.ndarray) -> list[int]:
    return [x.shape[0], *map(int, _exact(x).sum(axis=0))]


def _squares_of(centres: list[int]):
    """Sums of squares of every centred dimension, then of the sum of it and each later one."""
    centre = np.array(centres, np.int64)

    def totals(x: np.ndarray) -> list[int]:
        y = _exact(x - centre, 2)
        found = []
        for i in range(y.shape[1]):
            own = y[:, i]
            pair = own[:, None] + y[:, i + 1:]
            found.append(int((own * own).sum()))
            found += map(int, (pair * pair).sum(axis=0))
        return found

    return totals


def polarised_covariance(n: int, rest: list[int], squares: list[int]) -> np.ndarray:
    """Covariances (divisor ``n``) from exact sums of squares; ``rest`` has the sums of the centred values.

    n^2 times a variance is n times the sum of squares less the square of the sum: whole numbers, divided once.
    """
    d = len(rest)
    spread = np.empty((d, d), object)
    place = iter(squares)
    for i in range(d):
        for j in range(i, d):
            whole = rest[i] if i == j else rest[i] + rest[j]
            spread[i, j] = n * next(place) - whole * whole
    result = np.empty((d, d))
    for i in range(d):
        result[i, i] = spread[i, i] / (n * n)
        for j in range(i + 1, d):
            result[i, j] = result[j, i] = (spread[i, j] - spread[i, i] - spread[j, j]) / (2 * n * n)
    return result


def fit(grid: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Learn from the distinct vectors of ``grid`` (``on_grid``); all but sums stays in the tasks."""
    distinct = stored(grid.select("x").distinct(), "fit-list")
    counted = _added(distinct, _sums)
    if not counted:
        return Whitening(0, [], np.empty((0, 0)), np.empty(0), np.empty((0, 0)), None)
    n, sums = counted[0], counted[1:]
    centres = [s // n for s in sums]
    squares = _added(distinct, _squares_of(centres))
    covariance = polarised_covariance(n, [s - n * c for s, c in zip(sums, centres)], squares)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1][:, :components]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[largest, range(vectors.shape[1])])
    model = Whitening(n, sums, covariance, values, vectors, None)
    return Whitening(n, sums, covariance, values, vectors, _identity_error(distinct, model))


def _centred(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S, exactly, and x - S / n."""
    centres = [s // model.n for s in model.sums]
    rest = [s - model.n * c for s, c in zip(model.sums, centres)]
    y = x - np.array(centres, np.int64)
    largest = model.n * (int(np.abs(y).max(initial=0)) + 1)
    if largest * largest * max(x.shape[1], 1) >= _LONG:
        y = y.astype(object)
    z = y * model.n - np.array(rest, y.dtype)
    return z, (z / model.n).astype(float)


def _identity_error(distinct: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance less the identity, over components with variance."""
    used = model.scales[:, ~np.isnan(model.scales).any(axis=0)]
    k = used.shape[1]
    if not k:
        return None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(k + k * k)
        for _, x in _matrices(batches):
            white = _centred(x, model)[1] @ used
            totals += np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(totals)), pa.int32()), pa.array(totals)], names=["place", "total"])

    rows = distinct.mapInArrow(run, "place int, total double").groupBy("place").agg(F.sum("total").alias("total")).collect()
    totals = np.array([r["total"] for r in sorted(rows, key=lambda r: r["place"])]) / model.n
    mean, second = totals[:k], totals[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def transform(grid: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and ``whitened`` (array, null entries where a component has no variance) of every row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scales = model.scales
        for part, x in _matrices(batches):
            z, centred = _centred(x, model)
            far = [d if d <= _LONG else None for d in (z * z).sum(axis=1).tolist()]
            white = centred @ scales
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("vec_id")), pa.array(far, pa.int64()),
                 pa.FixedSizeListArray.from_arrays(pa.array(white.ravel(), from_pandas=True), white.shape[1]).cast(
                     pa.list_(pa.float64()))],
                names=["vec_id", "deviation", "whitened"])

    kind = grid.schema["vec_id"].dataType.simpleString()
    return grid.mapInArrow(run, f"vec_id {kind}, deviation bigint, whitened array<double>")


def by_component(white: DataFrame, model: Whitening) -> DataFrame:
    """One row for each row and component, with the component's share of the variance and the fit's figures."""
    trace = float(np.trace(model.covariance))
    shares = [float(v) / trace if trace else None for v in model.variances[:model.vectors.shape[1]]]
    exploded = white.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    share = F.element_at(F.array(*[F.lit(s).cast("double") for s in shares or [None]]), F.col("component"))
    return exploded.withColumn("component", F.col("place") + 1).select(
        "vec_id", "component", F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        share.alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"))

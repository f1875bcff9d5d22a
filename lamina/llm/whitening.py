"""Whitening of embeddings: projections on the principal directions, each with variance one.

Vectors become integer lattice points, so sums over all of them are exact. The directions are fitted on the
distinct points: centred rows are reduced to one small triangular factor by QR decompositions, block by block
in each task and then in a tree of tasks, which never squares the data as a covariance matrix would. Its
singular values and vectors (``bidiagonal``) whiten all rows in one narrow pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.bidiagonal import principal
from lamina.llm.graph import stored

# The lattice, and how many directions are kept.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Entries beyond this size count as this size: larger ones are no whole numbers in double precision.
LARGEST = float(1 << 46)
BLOCK_VALUES = 1 << 20
FAN_IN = 64
MOST_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """What a fit has learnt: a handful of numbers per dimension and direction."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def deviations(self, points: np.ndarray) -> tuple[list, np.ndarray]:
        """(exact sums over dimensions of (n*x-S)**2, x-S/n as doubles) of points.

        Plain 64-bit arithmetic where nothing can overflow, Python's integers elsewhere; a sum that is no
        64-bit number is None.
        """
        centre = np.array([round(s / self.n) for s in self.sums], np.int64)
        off = points - centre
        rest = [s - self.n * int(c) for s, c in zip(self.sums, centre)]
        reach = self.n * (int(np.abs(off).max(initial=0)) + 1)
        if reach * reach * max(1, len(self.sums)) <= MOST_LONG:
            scaled = self.n * off - np.array(rest, np.int64)
            squares = (scaled * scaled).sum(axis=1).tolist()
        else:
            scaled = self.n * off.astype(object) - np.array(rest, object)
            squares = [s if s <= MOST_LONG else None for s in (scaled * scaled).sum(axis=1).tolist()]
        return squares, scaled.astype(float) / self.n

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.vectors / np.sqrt(self.values)


def lattice(vectors: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id long, x array<long>): usable vectors as lattice points.

    Left out are null vectors, those with null, NaN or infinite entries, and those of another length than
    most have (the longest of equally frequent ones). Repeated rows and null ids stay.
    """
    entries = F.col(column).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), entries.alias("v")).where(
        "v IS NOT NULL AND forall(v, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))"
    )
    lengths = rows.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    wanted = F.lit(lengths.length if lengths else 0)
    bounded = f"least(greatest(c, double({-LARGEST})), double({LARGEST}))"
    return rows.where(F.size("v") == wanted).select(
        "vec_id", F.expr(f"transform(v, c -> floor({SCALE}D * {bounded}) + {SHIFT}L)").alias("x")
    )


def matrices(batches: Iterable[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches with column x as a matrix of bounded size."""
    for batch in batches:
        step = max(1, BLOCK_VALUES // max(1, dims))
        for begin in range(0, batch.num_rows, step):
            part = batch.slice(begin, step)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _totals(points: DataFrame, dims: int) -> tuple[int, tuple[int, ...]]:
    """(number of points, exact sum per dimension): one partial sum per task, added up by dimension."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, count = np.zeros(dims, np.int64), np.zeros(dims, np.int64), 0
        for _, x in matrices(batches, dims):
            count += len(x)
            high += (x >> 26).sum(axis=0)
            low += (x & ((1 << 26) - 1)).sum(axis=0)
        sums = [(int(h) << 26) + int(lo) for h, lo in zip(high, low)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, dims), pa.int32()), pa.array(map(Decimal, [count, *sums]), pa.decimal128(38, 0))], ["d", "s"]
        )

    partial = points.select("x").mapInArrow(run, "d int, s decimal(38,0)")
    totals = {row.d: int(row.s) for row in partial.groupBy("d").agg(F.sum("s").alias("s")).collect()}
    return totals.get(-1, 0), tuple(totals.get(d, 0) for d in range(dims))


def _reduced(rows: DataFrame, parts: int, merge: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """One array from (part int, value array<double>), merged in a tree whose groups have at most FAN_IN rows."""

    fan_in = FAN_IN

    def join(table: pa.Table) -> pa.Table:
        value = merge([np.array(v, float) for v in table.column("value").to_pylist()])
        part = pa.array([table.column("part")[0].as_py() // fan_in], pa.int32())
        return pa.table({"part": part, "value": pa.array([value], pa.list_(pa.float64()))})

    while parts > fan_in:
        near = F.expr(f"part DIV {fan_in}").cast("int")
        rows = stored(rows.groupBy(near.alias("near")).applyInArrow(join, "part int, value array<double>"), "merged")
        parts = -(-parts // fan_in)
    last = [np.array(row.value, float) for row in rows.orderBy("part").collect()]
    return merge(last) if last else None


def _summed(batches: Iterable[pa.RecordBatch], dims: int, begin: np.ndarray, step: Callable) -> Iterator[pa.RecordBatch]:
    """One row for a task that had rows: its part, and ``step`` folded over its blocks."""
    state, seen = begin, False
    for _, x in matrices(batches, dims):
        state, seen = step(state, x), True
    part = [TaskContext.get().partitionId()] if seen else []
    yield pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array([state.ravel()] if seen else [], pa.list_(pa.float64()))], ["part", "value"]
    )


def triangular(rows: np.ndarray) -> np.ndarray:
    """The triangular factor of a QR decomposition, as a square matrix."""
    dims = rows.shape[1]
    factor = np.linalg.qr(rows, mode="r")
    return np.vstack([factor, np.zeros((dims - len(factor), dims))])


def distinct_points(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(x array<long>): each lattice point once, as a stored table. Copies are combined before the shuffle."""
    return stored(lattice(vectors, column).select("x").distinct(), "points")


def fit(points: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of distinct lattice points.

    Directions without variance are left out, so there are fewer than ``components`` of them if the points
    span fewer dimensions, and none for fewer than two points. The driver gets sums per dimension and
    at most 64 small triangular factors.
    """
    first = points.first()
    dims = len(first.x) if first else 0
    n, sums = _totals(points, dims) if dims else (0, ())
    plain = Whitening(n, sums, np.zeros(0), np.zeros((dims, 0)), 0.0)
    if n < 2:
        return plain

    def reduce(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def step(factor: np.ndarray, x: np.ndarray) -> np.ndarray:
            return triangular(np.vstack([factor, plain.deviations(x)[1]]))

        return _summed(batches, dims, np.zeros((dims, dims)), step)

    factor = _reduced(
        points.mapInArrow(reduce, "part int, value array<double>"),
        points.rdd.getNumPartitions(),
        lambda factors: triangular(np.vstack([f.reshape(dims, dims) for f in factors])).ravel(),
    ).reshape(dims, dims)
    values, directions = principal(factor, components)
    return Whitening(n, sums, values / n, directions, float((factor**2).sum()) / n)


def identity_error(points: DataFrame, fitted: Whitening) -> float | None:
    """Largest entry of the whitened points' covariance minus the identity; None without directions.

    Measured on the distinct points themselves: counts, means and centred products of blocks are merged.
    """
    dims, size = fitted.vectors.shape
    if not size:
        return None

    def merged(states: list[np.ndarray]) -> np.ndarray:
        total = states[0]
        for other in states[1:]:
            total = _joined(total, other, size)
        return total

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def step(state: np.ndarray, x: np.ndarray) -> np.ndarray:
            rows = fitted.whitened(fitted.deviations(x)[1])
            mean = rows.mean(axis=0)
            block = np.concatenate(([len(rows)], mean, ((rows - mean).T @ (rows - mean)).ravel()))
            return _joined(state, block, size)

        return _summed(batches, dims, np.zeros(1 + size + size * size), step)

    state = _reduced(points.mapInArrow(run, "part int, value array<double>"), points.rdd.getNumPartitions(), merged)
    return float(np.abs(state[1 + size :].reshape(size, size) / state[0] - np.eye(size)).max())


def _joined(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """(count, mean, centred products) of two sets of rows taken together."""
    count = left[0] + right[0]
    if not count:
        return left
    gap = right[1 : 1 + size] - left[1 : 1 + size]
    mean = left[1 : 1 + size] + gap * (right[0] / count)
    products = left[1 + size :] + right[1 + size :] + np.outer(gap, gap).ravel() * (left[0] * right[0] / count)
    return np.concatenate(([count], mean, products))


def whiten(vectors: DataFrame, fitted: Whitening, column: str = "embedding") -> DataFrame:
    """(vec_id, n, deviation, whitened array<double>): every usable row, in one narrow pass."""
    dims = len(fitted.sums)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in matrices(batches, dims):
            deviation, centred = fitted.deviations(x)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id"), pa.array([fitted.n] * len(x), pa.int64()), pa.array(deviation, pa.int64()),
                    pa.array(list(fitted.whitened(centred)), pa.list_(pa.float64())),
                ],
                ["vec_id", "n", "deviation", "whitened"],
            )

    schema = "vec_id long, n long, deviation long, whitened array<double>"
    if not len(fitted.values):
        return vectors.sparkSession.createDataFrame([], schema)
    return lattice(vectors, column).mapInArrow(run, schema)


def report(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per usable vector and direction.

    No rows for an empty table or one whose vectors are all alike. A deviation beyond 64 bits is null.
    Repeated rows and ids, and rows with null ids, give their own result rows.
    """
    points = distinct_points(vectors, column)
    fitted = fit(points, components)
    error = identity_error(points, fitted)
    shares = F.array(*(F.lit(float(value / fitted.trace)) for value in fitted.values))
    placed = whiten(vectors, fitted, column).select("vec_id", "n", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return placed.select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
        F.get(shares, F.col("place")).cast("double").alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )

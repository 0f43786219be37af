"""Whitened embeddings by spectrum slicing of their covariance.

Components become whole numbers, floor(scale * c) + offset, so that sums are exact at any
number of rows and in any order. One pass adds up the rows and the sums S; a second takes
products of rows less the whole part of the mean, centred before they are multiplied, and
a correction by what the whole part left: both add matrices of one task, whose size is
that of the dimension squared, to one. The driver holds that one matrix. Its leading
eigenpairs come from ``spectrum``: counts of L D L' isolate each, Rayleigh quotients
converge to it, counts certify its number.

A third pass whitens all rows and takes the covariance of the result, whose largest
departure from the identity goes with every row; the last returns the rows.

Defined results: rows whose vector is null, empty or holds null or non-finite entries, or
has another length than most vectors (of equally many the larger length) take no part; a
null id stays one; repeated rows count each time; of a covariance with fewer than ``most``
eigenvalues above rounding only these have components; where all vectors are equal, or
the table is empty, there are no rows; a deviation beyond 64 bits is an error, not a
wrapped number; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import column
from .spectrum import Pair, leading

_ROWS = 4096
_LARGE = 1 << 62


def _valid(rows: DataFrame, vector: str, key: str) -> DataFrame:
    own = column(rows, vector).cast("array<double>")
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return rows.select(column(rows, key, "vec_id"), own.alias("v")).where(
        (F.size("v") > 0) & F.forall("v", fine)
    )


def _blocks(batch: pa.RecordBatch, name: str, scale: int, offset: int) -> Iterator[tuple[int, np.ndarray]]:
    """First row and whole numbers of some rows at a time: 64-bit ones where they fit."""
    lists = batch.column(name)
    width = len(lists[0]) if len(lists) else 0
    flat = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    for lo in range(0, len(flat), _ROWS):
        x = np.floor(scale * flat[lo : lo + _ROWS])
        if np.abs(x).max(initial=0) < _LARGE - offset:
            yield lo, x.astype(np.int64) + offset
        else:
            yield lo, np.array([[int(c) + offset for c in row] for row in x.tolist()], object).reshape(x.shape)


def _largest(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def _array(values: list[int]) -> np.ndarray:
    """Whole numbers as 64-bit ones where they fit."""
    return np.array(values, np.int64 if max(map(abs, values)) < _LARGE // 2 else object)


def _exact_product(y: np.ndarray) -> np.ndarray:
    """y' y in whole numbers, in the fastest form that is exact."""
    bound = _largest(y) ** 2 * max(len(y), 1)
    if bound < 1 << 53:
        z = y.astype(np.float64)
        return (z.T @ z).astype(np.int64).astype(object)
    if bound < 1 << 63:
        return (y.T @ y).astype(object)
    z = y.astype(object)
    return z.T.dot(z)


def _summed(rows: DataFrame, run) -> dict[tuple[int, int], int]:
    """Whole numbers by place, added up over all tasks. Beyond 38 digits: an error."""
    found = (
        rows.mapInArrow(run, "i int, j int, n decimal(38,0)")
        .groupBy("i", "j")
        .agg(F.sum("n").cast("decimal(38,0)").alias("n"))
    )
    return {(r.i, r.j): int(r.n) for r in found.collect()}


def _cells(values: dict[tuple[int, int], int]) -> pa.RecordBatch:
    places = [k for k, n in values.items() if n]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _ in places], pa.int32()),
            pa.array([j for _, j in places], pa.int32()),
            pa.array([values[k] for k in places], pa.decimal128(38, 0)),
        ],
        names=["i", "j", "n"],
    )


def _less(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """The difference, exact."""
    if _largest(x) >= _LARGE // 2:
        x = x.astype(object)
    return x - centre


def _sums(scale: int, offset: int):
    """Place (0, 0) has the number of rows, (1, j) the sum of dimension j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            for _, x in _blocks(batch, "v", scale, offset):
                own = (x.astype(object) if _largest(x) > 1 << 50 else x).sum(axis=0)
                total = own.astype(object) if total is None else total + own
                n += len(x)
        if n:
            yield _cells({(0, 0): n} | {(1, j): int(s) for j, s in enumerate(total)})

    return run


def _products(scale: int, offset: int, centre: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in _blocks(batch, "v", scale, offset):
                own = _exact_product(_less(x, _array(centre)))
                total = own if total is None else total + own
        if total is not None:
            d = len(centre)
            yield _cells({(i, j): int(total[i, j]) for i in range(d) for j in range(i + 1)})

    return run


@dataclass
class Whitening:
    """What turns a vector into its whitened components."""

    n: int
    sums: list[int]
    trace: float
    pairs: list[Pair]
    scale: int
    offset: int
    identity_error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """One row per vector, one column per component."""
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        near = _less(x, _array([s // self.n for s in self.sums])).astype(np.float64) - rest
        axes = np.array([p.vector / p.value**0.5 for p in self.pairs])
        return near @ axes.T

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums over the dimensions of (n x - S) squared, exact."""
        far = max(self.n * _largest(x), max(map(abs, self.sums)))
        if 4 * far * far * x.shape[1] < 1 << 62:
            y = self.n * x - np.array(self.sums)
            return (y * y).sum(axis=1).tolist()
        y = self.n * x.astype(object) - np.array(self.sums, object)
        return [int(s) for s in (y * y).sum(axis=1)]


def _covariance(centred: dict, first: list[int], n: int) -> np.ndarray:
    """From sums of products less the whole part of the mean and what that part left,
    rounded once per entry."""
    d = len(first)
    out = np.zeros((d, d))
    for i in range(d):
        for j in range(i + 1):
            out[i, j] = out[j, i] = (n * centred.get((i, j), 0) - first[i] * first[j]) / (n * n)
    return out


def fit(
    rows: DataFrame,
    most: int = 8,
    scale: int = 1024,
    offset: int = 100_000,
    vector: str = "embedding",
    key: str = "vec_id",
) -> tuple[DataFrame, Whitening | None]:
    """The rows that take part, as ``vec_id, v``, and their whitening; none without any
    variance."""
    valid = _valid(rows, vector, key)
    lengths = valid.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    if usual is None:
        return valid, None
    valid = valid.where(F.size("v") == usual.d)
    # Ids stay out of the passes that need none.
    vectors = valid.select("v")
    counted = _summed(vectors, _sums(scale, offset))
    n = counted[0, 0]
    sums = [counted.get((1, j), 0) for j in range(usual.d)]
    centre = [s // n for s in sums]
    centred = _summed(vectors, _products(scale, offset, centre))
    covariance = _covariance(centred, [s - n * c for s, c in zip(sums, centre)], n)
    trace = float(np.trace(covariance))
    rounding = 16 * usual.d * np.finfo(float).eps * trace
    pairs = [p for p in leading(covariance, most) if p.value > rounding] if trace > 0 else []
    if not pairs:
        return valid, None
    model = Whitening(n, sums, trace, pairs, scale, offset)
    model.identity_error = _identity_error(vectors, model)
    return valid, model


def _identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance less the identity."""
    k = len(model.pairs)

    def summed(centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k + 1, k))
            for batch in batches:
                for _, x in _blocks(batch, "v", model.scale, model.offset):
                    z = model.whitened(x) - centre
                    total[0] += z.sum(axis=0)
                    total[1:] += z.T @ z
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], names=["i", "x"]
            )

        found = vectors.mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x"))
        out = np.zeros((k + 1) * k)
        for r in found.collect():
            out[r.i] = r.x
        out = out.reshape(k + 1, k) / model.n
        return out[0], out[1:]

    # The mean is rounding only; products are taken less it all the same.
    mean, _ = summed(np.zeros(k))
    left, products = summed(mean)
    return float(np.abs(products - np.outer(left, left) - np.eye(k)).max())


def _whitened(model: Whitening):
    k = len(model.pairs)
    explained = np.array([p.value / model.trace for p in model.pairs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, x in _blocks(batch, "v", model.scale, model.offset):
                m = len(x)
                ids = batch.column("vec_id").slice(lo, m).take(pa.array(np.repeat(np.arange(m), k)))
                far = pa.array(model.deviations(x), pa.int64())
                columns = {
                    "vec_id": ids,
                    "component": pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    "n": pa.array(np.full(m * k, model.n), pa.int64()),
                    "deviation": far.take(pa.array(np.repeat(np.arange(m), k))),
                    "whitened": pa.array(model.whitened(x).ravel()),
                    "explained": pa.array(np.tile(explained, m)),
                    "identity_error": pa.array(np.full(m * k, model.identity_error)),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def whitened_vectors(
    rows: DataFrame,
    most: int = 8,
    scale: int = 1024,
    offset: int = 100_000,
    vector: str = "embedding",
    key: str = "vec_id",
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: up to
    ``most`` rows per vector."""
    valid, model = fit(rows, most, scale, offset, vector, key)
    kind = valid.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double"
    )
    if model is None:
        return valid.limit(0).mapInArrow(lambda batches: iter(()), schema)
    return valid.mapInArrow(_whitened(model), schema)

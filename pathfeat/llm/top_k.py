"""Exact top-k inner products by bounds from segment statistics at several resolutions.

Components are turned into floor(scale * x). For every vector and every resolution, the
mean and the deviation of each segment of components are known; for two vectors, the
distances of these pairs, times the segment's size, sum up to at most their squared
distance. With the norms that bounds the inner product from above. A query goes through
the resolutions from coarse to fine, each over the candidates the one before left, and
exact products are computed only for candidates whose finest bound reaches the k-th best
product found so far.

Queries are searched in blocks of ``block_rows``, which bounds what is broadcast; every
task keeps k results per query, and these meet by query.

Defined results: rows without an id, null vectors and vectors holding null or non-finite
components take no part; a query's own id is no candidate, other rows that repeat an id
each are; a repeated query id is searched once, by its least vector; vectors of another
length than the query's are no candidates; ties go to the smaller id; fewer candidates
give fewer rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import column

_BATCH = 4096
_RESOLUTIONS = (4, 16)


def _statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Segment means and deviations, each times the root of the segment's size, so that
    sums of products bound inner products."""
    edges = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(np.int64)
    size = np.diff(edges)
    sums = np.add.reduceat(x, edges[:-1], axis=1)
    squares = np.add.reduceat(x * x, edges[:-1], axis=1)
    mean = sums / size
    deviation = np.sqrt(np.maximum(squares / size - mean * mean, 0))
    return np.concatenate([mean, deviation], axis=1) * np.tile(np.sqrt(size), 2)


class Block:
    """Queries of one length, with the best results of a task so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.whole, self.k = ids, vectors, k
        self.vectors = vectors.astype(np.float64)
        self.levels = [_statistics(self.vectors, s) for s in _RESOLUTIONS]
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]

    def add(self, ids: np.ndarray, whole: np.ndarray) -> None:
        vectors = whole.astype(np.float64)
        levels = [_statistics(vectors, s) for s in _RESOLUTIONS]
        largest = _largest(whole) * _largest(self.whole) * whole.shape[1]
        # Products of equal statistics can exceed a bound by rounding only.
        slack = 1e-6 * (1 + np.abs(vectors).max() * np.abs(self.vectors).max() * vectors.shape[1])
        coarse = levels[0] @ self.levels[0].T
        for q in range(len(self.ids)):
            have, scores = self.best[q]
            least = scores[-1] - slack if len(have) == self.k else -np.inf
            left = np.flatnonzero((coarse[:, q] >= least) & (ids != self.ids[q]))
            for mine, theirs in zip(self.levels[1:], levels[1:]):
                left = left[theirs[left] @ mine[q] >= least]
            if not len(left):
                continue
            # Exact in doubles, in 64 bits, or in Python's integers.
            if largest < 1 << 53:
                score = np.rint(vectors[left] @ self.vectors[q]).astype(np.int64)
            else:
                kind = np.int64 if largest < 1 << 63 else object
                score = whole[left].astype(kind) @ self.whole[q].astype(kind)
            have = np.concatenate([have, ids[left]])
            scores = np.concatenate([scores, score])
            if scores.dtype == object:
                order = np.array(sorted(range(len(have)), key=lambda i: (-scores[i], have[i])))
            else:
                order = np.lexsort([have, -scores])
            self.best[q] = have[order[: self.k]], scores[order[: self.k]]


def _largest(whole: np.ndarray) -> int:
    """The largest absolute value, exactly."""
    return max(int(whole.max()), -int(whole.min()))


def _searcher(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Block] = {}
        for n, (ids, vectors) in shared.value.items():
            found[n] = Block(ids, vectors, k)
        for batch in batches:
            for lo in range(0, batch.num_rows, _BATCH):
                part = batch.slice(lo, _BATCH)
                ids = part.column("id").to_numpy(zero_copy_only=False)
                column = part.column("v")
                size = np.diff(column.offsets.to_numpy())
                flat = column.flatten().to_numpy(zero_copy_only=False)
                begin = np.cumsum(size) - size
                for n in np.unique(size).tolist():
                    if n in found:
                        own = np.flatnonzero(size == n)
                        found[n].add(ids[own], flat[begin[own][:, None] + np.arange(n)])
        for block in found.values():
            sizes = [len(b[0]) for b in block.best]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(block.ids, sizes)),
                    pa.array(np.concatenate([b[0] for b in block.best])),
                    pa.array(np.concatenate([b[1] for b in block.best]).astype(np.int64)),
                ],
                names=["query_id", "vec_id", "score"],
            )

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    block_rows: int = 4096,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k largest products of every query.

    ``is_query`` is a condition on the column ``id``. Products and sums are exact at any
    size; a scaled component or a score of the result that 64 bits can't hold is an error.
    """
    x = F.col("v")
    usable = F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    )
    beyond = F.raise_error(F.lit("a scaled component does not fit 64 bits"))

    def scaled(c: Column) -> Column:
        fits = F.abs(c * scale) < F.lit(2.0**63)
        return F.when(fits, F.floor(c * scale).cast("bigint")).otherwise(beyond.cast("bigint"))

    whole = (
        vectors.select(
            column(vectors, key).cast("bigint").alias("id"),
            column(vectors, vector).cast("array<double>").alias("v"),
        )
        .where(F.col("id").isNotNull() & x.isNotNull() & usable & (F.size(x) > 0))
        .select("id", F.transform(x, scaled).alias("v"))
    )
    queries = whole.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
    n_blocks = max(1, -(-queries.count() // block_rows))
    block = F.pmod(F.xxhash64("id"), F.lit(n_blocks))
    found = None
    for b in range(n_blocks):
        by_size: dict[int, list] = {}
        for r in queries.where(block == b).orderBy("id").collect():
            by_size.setdefault(len(r.v), []).append(r)
        own = {
            n: (np.array([r.id for r in rows], np.int64), np.array([r.v for r in rows], np.int64))
            for n, rows in by_size.items()
        }
        shared = vectors.sparkSession.sparkContext.broadcast(own)
        part = whole.mapInArrow(_searcher(shared, k), "query_id bigint, vec_id bigint, score bigint")
        found = part if found is None else found.union(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

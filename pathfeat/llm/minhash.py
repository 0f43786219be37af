"""Near-duplicate documents by MinHash with sequential Bayesian verification.

Words are runs of bytes other than white space, A-Z lower-cased; a document's set is its
distinct shingles of five words, or its whole word sequence if it has fewer. Two
documents are linked if the Jaccard similarity of their sets is at least the threshold.

1. A task per split computes each document's set size, a digest of the set and a
   signature of minima. Documents with equal sets form a class; the least id stands for
   it, and copies go no further.
2. Signatures are cut into bands. Buckets of equal bands propose candidates; buckets
   with the same members are looked at once.
3. First every member is compared with the least one of its bucket. Signatures are read
   in batches; after each, a pair is dropped once the posterior probability that its
   similarity reaches the threshold is below ``miss``. Survivors are verified exactly
   on their full sets, and confirmed links give components.
4. Buckets that still span several components are dealt into chunks of bounded members
   and bytes. Members of the bucket's largest component are already connected: they meet
   the chunks of the others, which meet one another too, by the same tests, the exact one
   in the same task. So a stray in a large group sends each member once. A task returns
   only links that join something, so the pairs of a large group are never rows, and no
   link between different components is missed for not being a star's.

Every candidate with similarity s shares a band with probability
1 - (1 - s^rows)^bands; with the defaults a pair at the threshold is missed once in two
million.

Defined results: documents without words (null and empty texts) have 0 shingles and are
their own component; a row without an id has no component and is kept; rows that repeat
an id get the same columns each by its own text; an empty table gives no rows; columns
other than the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.staging import Staging, stage, staging_root
from .columns import (
    blocks,
    column,
    give_back,
    give_back_driver,
    lowered,
    mixed,
    row_of,
    span_hashes,
    text_bytes,
    word_spans,
)
from .components import components

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False

_BLOCK_BYTES = 1 << 19
_CHUNK = 256
_CHUNK_BYTES = 4 << 20


def shingle_sets(
    raw: np.ndarray, offsets: np.ndarray, width: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of every row, ascending, and the n + 1 offsets."""
    raw = lowered(raw)
    starts, ends, first = word_spans(raw, offsets, IS_WORD)
    words = span_hashes(raw, starts, ends)
    count = np.diff(first)
    size = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    edge = np.concatenate([[0], np.cumsum(size)])
    begin = np.arange(edge[-1]) + np.repeat(first[:-1] - edge[:-1], size)
    room = np.repeat(first[1:], size) - begin
    out = np.zeros(len(begin), np.uint64)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    factor = mixed(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    for k in range(width):
        out += np.where(k < room, padded[begin + k], np.uint64(k)) * factor[k]
    out = mixed(out)
    for lo, hi in zip(edge.tolist(), edge[1:].tolist()):
        out[lo:hi].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[edge[:-1][size > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return out[new], kept[edge]


def _factors(n: int) -> np.ndarray:
    return mixed(np.arange(1 << 20, (1 << 20) + n, dtype=np.uint64)) | np.uint64(1)


def signatures(sets: np.ndarray, edge: np.ndarray, hashes: int) -> np.ndarray:
    """The least value of every row's set under each hash; rows without any get zeros."""
    out = np.zeros((len(edge) - 1, hashes), np.uint32)
    full = np.flatnonzero(np.diff(edge))
    begin = edge[full]
    for k, factor in enumerate(_factors(hashes)):
        if len(full):
            out[full, k] = np.minimum.reduceat(sets * factor, begin) >> np.uint64(32)
    return out


def _profiles(width: int, hashes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back(others=True)
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            parts = []
            for lo, hi in blocks(offsets, _BLOCK_BYTES):
                own = raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                sets, edge = shingle_sets(*own, width)
                n = np.diff(edge)
                sums = np.zeros((2, len(n)), np.uint64)
                full = n > 0
                if full.any():
                    sums[0, full] = np.add.reduceat(sets, edge[:-1][full])
                    sums[1, full] = np.add.reduceat(mixed(sets), edge[:-1][full])
                parts.append((n, sums, signatures(sets, edge, hashes)))
            if not parts:
                continue
            n = np.concatenate([p[0] for p in parts])
            sums = np.concatenate([p[1] for p in parts], axis=1).view(np.int64)
            flat = np.concatenate([p[2] for p in parts]).astype(">u4")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(n, pa.int64()),
                    pa.array(sums[0]),
                    pa.array(sums[1]),
                    _rows_of_bytes(flat, n > 0),
                ],
                names=["key", "n", "s1", "s2", "sig"],
            )
        give_back()

    return run


def _rows_of_bytes(table: np.ndarray, keep: np.ndarray) -> pa.Array:
    """One binary value per row of a table; null where it isn't kept."""
    width = table.shape[1] * table.itemsize
    edges = np.concatenate([[0], np.cumsum(np.where(keep, width, 0))]).astype(np.int32)
    mask = pa.array(keep).buffers()[1] if len(keep) else None
    data = pa.py_buffer(np.ascontiguousarray(table[keep]).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(keep), [mask, pa.py_buffer(edges), data])


def least_matches(batch: int, hashes: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """After so many hashes, the least matches with which a pair goes on.

    With a uniform prior, m matches of n leave Beta(m + 1, n - m + 1) for the
    similarity, and it reaches the threshold with the probability that at most m of
    n + 1 draws with that chance succeed.
    """
    out = []
    for n in range(batch, hashes + 1, batch):
        total, least = 0.0, 0
        for m in range(n + 1):
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                least = m
                break
        out.append((n, least))
    return out


def plausible(a: np.ndarray, b: np.ndarray, limits: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of two signature tables may reach the threshold, batch by batch."""
    live = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    done = 0
    for n, least in limits:
        matches[live] += (a[live, done:n] == b[live, done:n]).sum(axis=1)
        live = live[matches[live] >= least]
        done = n
    return live


def _table(column: pa.Array, hashes: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, ">u4", (at[-1] - at[0]) // 4, int(at[0])).reshape(-1, hashes)


def _plausible_pairs(hashes: int, limits: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                tables = [_table(batch.column(c), hashes) for c in ("sig_a", "sig_b")]
                live = pa.array(plausible(*tables, limits))
                names = ["a", "b", "text_a", "text_b"]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(live) for c in names], names=names
                )

    return run


def _linked_pairs(hashes: int, limits: list[tuple[int, int]], width: int, top: int, bottom: int):
    """Plausible pairs that full sets confirm. Both steps are one operator of the plan: two
    would keep two worker processes for each core."""
    candidates, confirmed = _plausible_pairs(hashes, limits), _confirmed(width, top, bottom)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back(others=True)
        yield from confirmed(candidates(batches))
        give_back()

    return run


def _linked_chunks(hashes: int, limits: list[tuple[int, int]], width: int, top: int, bottom: int):
    """Links between different components within a chunk or a pair of chunks. A pair that
    links found here already connect is not looked at: what comes out is a forest."""

    def run(table: pa.Table) -> pa.Table:
        give_back(others=True)
        table = table.combine_chunks()
        chunk = table.column("chunk").to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        first, second = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        sets, edge = shingle_sets(*text_bytes(table.column("text")), width)
        sig = _table(table.column("sig"), hashes)
        number: dict = {}
        comp = [number.setdefault(c, len(number)) for c in table.column("component").to_pylist()]
        comp = np.array(comp, np.int64)
        trees = Forest()
        found: list[list[int]] = [[], []]
        for k in first.tolist():
            rest = second[comp[second] != comp[k]]
            rest = rest[rest > k] if i == j else rest
            own = sets[edge[k] : edge[k + 1]]
            left = np.broadcast_to(sig[k], (len(rest), hashes))
            for m in rest[plausible(left, sig[rest], limits)].tolist():
                a, b = int(comp[k]), int(comp[m])
                if trees.root(a) == trees.root(b):
                    continue
                his = sets[edge[m] : edge[m + 1]]
                shared = np.intersect1d(own, his, assume_unique=True).size
                if bottom * shared >= top * (len(own) + len(his) - shared):
                    trees.join(a, b)
                    found[0].append(k)
                    found[1].append(m)
        rep = table.column("rep")
        links = [rep.take(pa.array(f, pa.int64())) for f in found]
        return pa.Table.from_arrays(links, names=["a", "b"])

    return run


class Forest:
    """Sets of small numbers that can be joined."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while x in self.up:
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[x] = y


def _confirmed(width: int, top: int, bottom: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            a, b = (text_bytes(batch.column(c)) for c in ("text_a", "text_b"))
            step = max(1, int(batch.num_rows * _BLOCK_BYTES / max(1, len(a[0]) + len(b[0]))))
            for lo in range(0, batch.num_rows, step):
                hi = min(lo + step, batch.num_rows)
                both = []
                for raw, at in (a, b):
                    own = raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
                    sets, edge = shingle_sets(*own, width)
                    both.append((sets, edge))
                (x, ex), (y, ey) = both
                for k in range(hi - lo):
                    p, q = x[ex[k] : ex[k + 1]], y[ey[k] : ey[k + 1]]
                    shared = np.intersect1d(p, q, assume_unique=True).size
                    ok[lo + k] = bottom * shared >= top * (len(p) + len(q) - shared)
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(keep) for c in "ab"], names=["a", "b"]
            )

    return run


def near_duplicates(
    docs: DataFrame,
    threshold: tuple[int, int] = (85, 100),
    width: int = 5,
    bands: int = 25,
    rows: int = 5,
    batch: int = 25,
    miss: float = 1e-9,
    most_chunks: int = 32,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key, n_shingles, component_id, kept`` of every row.

    ``threshold`` is a fraction of integers, so that the exact test has no rounding.
    ``miss`` is the posterior probability below which a pair is dropped unverified;
    ``most_chunks`` is how many chunks buckets that share members may make together.
    The jobs run when this is called; tables on the way are deleted.
    """
    own = Staging(staging_root(docs.sparkSession))
    with own:
        found = _near_duplicates(docs, threshold, width, bands, rows, batch, miss, most_chunks, key, text)
    found = stage(found, "near-duplicates")
    own.close()
    give_back_driver(docs.sparkSession)
    return found


def _near_duplicates(
    docs: DataFrame,
    threshold: tuple[int, int],
    width: int,
    bands: int,
    rows: int,
    batch: int,
    miss: float,
    most_chunks: int,
    key: str,
    text: str,
) -> DataFrame:
    top, bottom = threshold
    hashes = bands * rows
    limits = least_matches(batch, hashes, top / bottom, miss)
    source = docs.select(column(docs, key, "key"), column(docs, text, "text"))
    kind = source.schema["key"].dataType.simpleString()
    profile = source.mapInArrow(
        _profiles(width, hashes), f"key {kind}, n bigint, s1 bigint, s2 bigint, sig binary"
    )
    profile = stage(profile, "profiles")
    classes = (
        profile.where("n > 0 and key is not null")
        .groupBy("s1", "s2", "n")
        .agg(F.min("key").alias("rep"), F.first("sig").alias("sig"))
    )
    classes = stage(classes, "classes")

    slices = [
        F.xxhash64(F.lit(i), F.substr("sig", F.lit(4 * rows * i + 1), F.lit(4 * rows)))
        for i in range(bands)
    ]
    banded = classes.select("rep", F.explode(F.array(*slices)).alias("bucket"))
    shared = (
        banded.groupBy("bucket")
        .agg(
            F.count("*").alias("size"),
            F.min("rep").alias("least"),
            F.sum(F.xxhash64("rep") % (1 << 40)).alias("digest"),
            F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("check"),
        )
        .where("size > 1")
        .groupBy("size", "least", "digest", "check")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket", "size", "least")
    )
    members = stage(banded.join(shared, "bucket"), "members")
    sigs = classes.select("rep", "sig")
    pair = f"a {kind}, b {kind}"

    # One text per class: rows may repeat an id, with texts of other sets. The hint keeps
    # one plan at every size.
    candidates = members.select(F.col("rep").alias("key")).distinct()
    own = classes.select(F.col("rep").alias("key"), "s1", "s2")
    texts = (
        source.join(candidates.hint("merge"), "key", "left_semi")
        .mapInArrow(_with_digests(width), f"key {kind}, text string, s1 bigint, s2 bigint")
        .join(own.hint("merge"), ["key", "s1", "s2"], "left_semi")
        .groupBy("key")
        .agg(F.first("text").alias("text"))
        .withColumn("bytes", F.octet_length("text"))
    )
    texts = stage(texts.join(sigs.withColumnRenamed("rep", "key"), "key"), "texts")

    def side(name: str) -> DataFrame:
        return texts.select(
            F.col("key").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("text", "sig")]
        )

    stars = members.where("rep != least").select(F.col("least").alias("a"), F.col("rep").alias("b"))
    links = stars.distinct().join(side("b"), "b").join(side("a"), "a")
    links = links.mapInArrow(_linked_pairs(hashes, limits, width, top, bottom), pair)
    links = stage(links, "links")
    labels = components(links)
    give_back_driver(docs.sparkSession)

    named = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.withColumn("component", F.coalesce("component", "rep"))
    spans = (
        named.groupBy("bucket")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo != hi")
        .select("bucket")
    )
    left = stage(named.join(spans, "bucket"), "open")
    if not left.isEmpty():
        give_back_driver(docs.sparkSession)
        facing = _facing(left, texts, most_chunks).groupBy("grp", "apart", "i", "j")
        more = facing.applyInArrow(_linked_chunks(hashes, limits, width, top, bottom), pair)
        labels = components(links.union(stage(more, "links")))

    of_class = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "s1", "s2", "n", F.coalesce("component", "rep").alias("component")
    )
    single = F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("component"))
    found = F.when(F.col("key").isNotNull(), single)
    return (
        profile.select("key", "n", "s1", "s2")
        .join(of_class, ["s1", "s2", "n"], "left")
        .select(
            F.col("key").alias(key),
            F.col("n").alias("n_shingles"),
            found.alias("component_id"),
            F.coalesce(F.col("key") == found, F.lit(True)).alias("kept"),
        )
    )


def _facing(members: DataFrame, texts: DataFrame, most_chunks: int) -> DataFrame:
    """Members by pairs of chunks ``i, j`` that cover every pair of a bucket but those in
    its largest component; a member is there once for each chunk its own one meets.

    Buckets that share members are taken together, so that a document is sent once, not
    once per bucket; if that makes too many chunks, each bucket stands for itself.
    """
    met = components(members.select(F.col("least").alias("a"), F.col("rep").alias("b")))
    met = met.select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    sizes = met.groupBy("cluster").agg(F.count("*").alias("in_cluster"))
    placed = (
        members.join(met, "rep")
        .join(sizes, "cluster")
        .withColumn("apart", F.col("in_cluster") > most_chunks * _CHUNK)
        .select(
            F.when(F.col("apart"), F.col("bucket")).otherwise(F.xxhash64("cluster")).alias("grp"),
            "apart",
            "rep",
            "component",
        )
        .distinct()
        .join(texts.select(F.col("key").alias("rep"), "bytes"), "rep")
    )
    placed = stage(placed, "placed")
    group = ["grp", "apart"]
    parts = placed.groupBy(*group, "component").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    total = lambda c, big: F.sum(F.when(F.col("big") == big, F.col(c)).otherwise(0))
    largest = parts.groupBy(*group).agg(F.max_by("component", F.struct("n", "component")).alias("largest"))
    chunks = lambda big: F.greatest(
        F.ceil(total("n", big) / _CHUNK), F.ceil(total("bytes", big) / _CHUNK_BYTES)
    ).cast("int")
    dealt = (
        parts.join(largest, group)
        .withColumn("big", F.col("component") == F.col("largest"))
        .groupBy(*group, "largest")
        .agg(chunks(False).alias("n_small"), chunks(True).alias("n_big"))
    )
    place = F.pmod(F.xxhash64("rep", F.lit(2)), F.when(F.col("big"), F.col("n_big")).otherwise(F.col("n_small")))
    chunk = (place + F.when(F.col("big"), F.col("n_small")).otherwise(0)).cast("int").alias("chunk")
    # The largest component meets the others' chunks, these meet all.
    last = F.when(F.col("big"), F.col("n_small")).otherwise(F.col("n_small") + F.col("n_big")) - 1
    sent = (
        placed.join(dealt, group)
        .withColumn("big", F.col("component") == F.col("largest"))
        .select(*group, "rep", "component", chunk, F.explode(F.sequence(F.lit(0), last)).alias("other"))
    )
    rest = texts.select(F.col("key").alias("rep"), "sig", "text")
    return sent.join(rest, "rep").select(
        *group,
        F.least("chunk", "other").alias("i"),
        F.greatest("chunk", "other").alias("j"),
        "chunk",
        "rep",
        "component",
        "sig",
        "text",
    )


def _with_digests(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back(others=True)
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            sums = np.zeros((2, batch.num_rows), np.uint64)
            for lo, hi in blocks(offsets, _BLOCK_BYTES):
                own = raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                sets, edge = shingle_sets(*own, width)
                rows = row_of(edge) + lo
                np.add.at(sums[0], rows, sets)
                np.add.at(sums[1], rows, mixed(sets))
            sums = sums.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("text"), pa.array(sums[0]), pa.array(sums[1])],
                names=["key", "text", "s1", "s2"],
            )
        give_back()

    return run

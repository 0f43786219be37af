"""Text quality from random-indexing word vectors and a two-layer network.

Every word and every word shape (its case, the marks it ends in, whether it repeats the
word before it) has a slot by hash and a sparse random index vector. Over all documents,
a slot's vector sums the index vectors of its neighbours in the sequence of words and
shapes. A document is pooled as the weighted mean of the vectors of its words and that of
its shapes; a two-layer network gives a probability whose temperature is fitted on labelled documents that the weights weren't fitted on.

The slots and dimensions bound the model whatever the corpus; its sums are pre-aggregated
per task and added up by slot.

Defined results: null and empty texts have no words and pool to zeros; a null id counts
as not held out; repeated rows are scored each; an empty table gives no rows; without
labels of both kinds the score is the share of label 1, and 0.5 without labels; columns
other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import blocks, column, lowered, mixed, row_of, span_hashes, text_bytes, word_spans
from .sampling import labelled_sample

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_UPPER = np.zeros(256, np.int8)
_UPPER[65:91] = 1
_LETTER = np.zeros(256, np.int8)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = 1
_DIGIT = np.zeros(256, np.int8)
_DIGIT[48:58] = 1

WORD_SLOTS = 1 << 14
SHAPE_SLOTS = 1 << 9
DIMENSIONS = 32
_NONZERO = 4
_BLOCK_BYTES = 1 << 19


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Dimension and sign of the entries of every slot's index vector."""
    slots = WORD_SLOTS + SHAPE_SLOTS
    h = mixed(np.arange(slots * _NONZERO, dtype=np.uint64)).reshape(slots, _NONZERO)
    sign = np.where((h >> np.uint64(40)) & np.uint64(1), 1, -1).astype(np.int8)
    return (h % np.uint64(DIMENSIONS)).astype(np.int64), sign


def _slots(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word slots, shape slots, and word offsets of the rows."""
    starts, ends, first = word_spans(raw, offsets, IS_WORD)
    h = span_hashes(lowered(raw), starts, ends)
    size = ends - starts

    def count(of: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(of[raw], out=sums[1:])
        return sums[ends] - sums[starts]

    upper, letter, digit = count(_UPPER), count(_LETTER), count(_DIGIT)
    case = np.select(
        [letter == 0, upper == 0, (upper == 1) & (_UPPER[raw[starts]] == 1), upper == letter],
        [0, 1, 2, 3],
        4,
    )
    mark = (_LETTER[raw] + _DIGIT[raw]) == 0
    last = np.where(mark[ends - 1], raw[ends - 1].astype(np.int64), 0) if len(ends) else ends
    second = np.where((size > 1) & mark[ends - 2] & (last > 0), raw[ends - 2], 0) if len(ends) else ends
    again = np.zeros(len(h), np.int64)
    again[1:] = h[1:] == h[:-1]
    again[first[:-1][first[:-1] < len(h)]] = 0
    shape = ((case * 256 + last) * 256 + second) * 4 + again * 2 + (digit > 0)
    shape = mixed(shape.astype(np.uint64) + np.uint64(1))
    word = (h % np.uint64(WORD_SLOTS)).astype(np.int64)
    return word, (shape % np.uint64(SHAPE_SLOTS)).astype(np.int64) + WORD_SLOTS, first


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one task: each slot's neighbours as sums of index vectors, and its uses."""
    dims, signs = _index_vectors()
    slots = WORD_SLOTS + SHAPE_SLOTS
    total = np.zeros(slots * DIMENSIONS, np.int64)
    uses = np.zeros(slots, np.int64)
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        for lo, hi in blocks(offsets, _BLOCK_BYTES):
            at = offsets[lo : hi + 1] - offsets[lo]
            word, shape, first = _slots(raw[offsets[lo] : offsets[hi]], at)
            tokens = np.stack([word, shape], axis=1).ravel()
            row = np.repeat(row_of(first), 2)
            uses += np.bincount(tokens, minlength=slots)
            for apart in (1, 2):
                same = row[apart:] == row[:-apart]
                left, right = tokens[:-apart][same], tokens[apart:][same]
                for a, b in ((left, right), (right, left)):
                    for k in range(_NONZERO):
                        key = a * DIMENSIONS + dims[b, k]
                        up = signs[b, k] > 0
                        total += np.bincount(key[up], minlength=len(total))
                        total -= np.bincount(key[~up], minlength=len(total))
    table = total.reshape(slots, DIMENSIONS)
    used = np.flatnonzero(uses)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), pa.array(uses[used]), *[pa.array(table[used, d]) for d in range(DIMENSIONS)]],
        names=["slot", "uses", *[f"d{d}" for d in range(DIMENSIONS)]],
    )


def word_vectors(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of all slots and their pooling weights, from all documents."""
    names = ["uses", *[f"d{d}" for d in range(DIMENSIONS)]]
    schema = "slot bigint, " + ", ".join(f"{c} bigint" for c in names)
    rows = (
        docs.select(column(docs, text, "text"))
        .mapInArrow(_sums, schema)
        .groupBy("slot")
        .agg(*[F.sum(c).alias(c) for c in names])
        .collect()
    )
    slots = WORD_SLOTS + SHAPE_SLOTS
    table, uses = np.zeros((slots, DIMENSIONS)), np.zeros(slots)
    if rows:
        data = np.array([tuple(r) for r in rows], np.float64)
        at = data[:, 0].astype(np.int64)
        uses[at], table[at] = data[:, 1], data[:, 2:]
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    table = table / np.where(norm > 0, norm, 1)
    part = uses / max(1.0, uses.sum())
    weight = 1e-3 / (1e-3 + part)
    return table.astype(np.float32), weight.astype(np.float32)


@dataclass
class Network:
    vectors: np.ndarray
    weight: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float
    constant: float | None = None

    def pooled(self, texts: pa.Array) -> np.ndarray:
        return pooled(texts, self.vectors, self.weight)

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh((x - self.mean) / self.scale @ self.hidden + self.hidden_bias)
        return h @ self.out + self.out_bias

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        z = self.logits(self.pooled(texts)) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def pooled(texts: pa.Array, vectors: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Of every text the mean word vector, the mean shape vector and the mean weights."""
    raw, offsets = text_bytes(texts)
    n = len(offsets) - 1
    out = np.zeros((n, 2 * DIMENSIONS + 2))
    weighted = vectors * weight[:, None]
    for lo, hi in blocks(offsets, _BLOCK_BYTES):
        at = offsets[lo : hi + 1] - offsets[lo]
        word, shape, first = _slots(raw[offsets[lo] : offsets[hi]], at)
        size = np.diff(first)
        full = np.flatnonzero(size)
        if not len(full):
            continue
        begin, rows = first[full], full + lo
        for k, slots in enumerate((word, shape)):
            table = weighted if k == 0 else vectors
            mean = np.add.reduceat(table[slots], begin, axis=0, dtype=np.float64)
            out[rows, k * DIMENSIONS : (k + 1) * DIMENSIONS] = mean / size[full, None]
            out[rows, 2 * DIMENSIONS + k] = np.add.reduceat(weight[slots], begin, dtype=np.float64) / size[full]
    return out


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learnable: Column,
    per_class: int = 3000,
    units: int = 24,
    rounds: int = 1500,
    rate: float = 0.02,
    decay: float = 1e-4,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Network:
    """Word vectors from all documents; weights from at most ``per_class`` labelled
    documents of each kind, by ``rounds`` steps of Adam. Every fourth document of the
    sample is kept back for the temperature."""
    vectors, weight = word_vectors(docs, text)
    sample = labelled_sample(docs, labels, label, learnable, per_class, key, text)
    x = pooled(pa.array(sample.texts, pa.string()), vectors, weight)
    y, w = sample.labels.astype(float), sample.weights / max(1e-9, sample.weights.sum())
    mean, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (0.0, 1.0)
    net = Network(vectors, weight, mean, scale, None, None, None, 0.0, 1.0)
    if len(set(sample.labels.tolist())) < 2:
        net.constant = float((w * y).sum()) if len(y) else 0.5
        return net
    rnd = np.random.default_rng(11)
    back = np.arange(len(y)) % 4 == 3
    z = (x - mean) / scale
    values = [
        rnd.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], units)),
        np.zeros(units),
        rnd.normal(0, 1 / np.sqrt(units), units),
        np.zeros(1),
    ]
    first = [np.zeros_like(v) for v in values]
    second = [np.zeros_like(v) for v in values]
    zt, yt, wt = z[~back], y[~back], w[~back] / w[~back].sum()
    for t in range(1, rounds + 1):
        a, b, c, d = values
        h = np.tanh(zt @ a + b)
        p = 1 / (1 + np.exp(-np.clip(h @ c + d, -30, 30)))
        e = wt * (p - yt)
        dh = np.outer(e, c) * (1 - h * h)
        steps = [zt.T @ dh + decay * a, dh.sum(0), h.T @ e + decay * c, np.array([e.sum()])]
        for i, g in enumerate(steps):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            rise = first[i] / (1 - 0.9**t) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
            values[i] = values[i] - rate * rise
    net.hidden, net.hidden_bias, net.out = values[:3]
    net.out_bias = float(values[3][0])
    raw, yb, wb = net.logits(x[back]), y[back], w[back]
    candidates = np.geomspace(0.2, 20, 80)
    losses = [(wb * np.logaddexp(0, np.where(yb > 0, -raw, raw) / t)).sum() for t in candidates]
    net.temperature = float(candidates[int(np.argmin(losses))])
    return net


def _scorer(shared):
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(shared.value.score(batch), pa.float64())

    return F.arrow_udf(score, "double")


def quality(
    docs: DataFrame,
    model: Network,
    carry: list[str] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``row``, a struct of the carried columns (the key alone unless said otherwise),
    and ``score``, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # Only the texts go to Python.
    return docs.select(
        F.struct(*[column(docs, c) for c in (carry or [key])]).alias("row"),
        _scorer(shared)(column(docs, text)).alias("score"),
    )

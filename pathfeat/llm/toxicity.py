"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

The model is fitted on a bounded sample of labelled documents. Of near copies of one
label the first stands for all, with their weight. Vectors are term frequency times
inverse document frequency over all lower-cased words of the examples; document
frequencies are counted over all documents.

Neighbours are found by block-max pruning. Examples are ordered so that like ones stand
together, and cut into blocks; the posting lists of common terms are cut at the same
places and store their largest weight in each block. A block's maxima bound the cosine of
all its examples; rare terms, whose lists are short, are added up as they are. Blocks of
the largest bounds come first, and one whose bound is below the k-th cosine so far is
skipped. Products with common terms are taken in single precision with room for its
rounding; examples that may be among the k nearest get them in double precision, beside
what rare terms added up to, so neighbours are exact.

Neighbours vote by their distance, and with them, as one more voter of the weight that an
example of cosine ``_TRUST`` has, a lexicon: the words and beginnings of 3 to 6 bytes that
toxic examples hold significantly more often. Its vote is a logistic curve of its density
in the text; it has no part in the cosines. The vote goes through a logistic curve, fitted
on votes that leave the example itself out, and gives a score, with the neighbours as
evidence.

Defined results: a text without any word of the examples (a null or empty one too) has no
neighbours and gets the share of toxic examples among such, or among all if there are
none; ties of cosine go to the
example of smaller id; a null id counts as not held out; repeated rows are scored each;
an empty table gives no rows; without labels of both kinds the score is the share of
toxic ones, 0 if there are none; columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import (
    blocks,
    column,
    give_back,
    give_back_driver,
    mixed,
    row_of,
    span_hashes,
    span_sums,
    text_bytes,
    word_spans,
)
from .minhash import shingle_sets
from .sampling import Sample, fit_logistic, labelled_sample

IS_WORD = np.zeros(256, bool)
IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True

_BLOCK_BYTES = 1 << 18
_FILTER_BITS = 20
_BEGINNINGS = (3, 4, 5, 6)
_SCALE = 200.0  # of the lexicon's density
_TRUST = 0.99
_QUERIES = 64
_TEXTS = 1024
_WIDTH = 32  # examples in a block
_AXES = 8


def _terms(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and hash of the words, then of their beginnings of each size."""
    starts, ends, first = word_spans(raw, offsets, IS_WORD)
    row, sums = row_of(first), span_sums(raw)
    yield row, span_hashes(raw, starts, ends, sums)
    for n in _BEGINNINGS:
        longer = np.flatnonzero(ends - starts > n)
        salt = mixed(np.array([n], np.uint64))[0]
        begin = starts[longer]
        yield row[longer], mixed(span_hashes(raw, begin, begin + n, sums) ^ salt)


def _lower(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(pc.utf8_lower(texts.fill_null("")))


def _seen(hashes: np.ndarray) -> np.ndarray:
    seen = np.zeros(1 << _FILTER_BITS, bool)
    seen[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
    return seen


@dataclass
class Vocabulary:
    """Sorted hashes of the words of the vectors and of the terms of the lexicon."""

    hashes: np.ndarray
    lexicon: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))

    def __post_init__(self) -> None:
        self.filters = [_seen(self.hashes), _seen(self.lexicon)]

    def __getstate__(self) -> dict:
        return {"hashes": self.hashes, "lexicon": self.lexicon}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, term and frequency per word of the terms in texts, in this order."""
        return self.scan(texts)[0]

    def scan(self, texts: pa.Array, lexicon: bool = False):
        """The counts, and for each text the terms of the lexicon that it holds per word."""
        raw, offsets = _lower(texts)
        rows, terms, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        density = np.zeros(len(texts))
        for lo, hi in blocks(offsets, _BLOCK_BYTES) if len(self.hashes) else ():
            at = offsets[lo : hi + 1] - offsets[lo]
            found = _terms(raw[offsets[lo] : offsets[hi]], at)
            row, h = next(found)
            words = np.maximum(np.bincount(row, minlength=hi - lo), 1)
            if lexicon and len(self.lexicon):
                for own, _ in (self._placed(self.lexicon, 1, *x) for x in [(row, h), *found]):
                    density[lo:hi] += np.bincount(own, minlength=hi - lo)
                density[lo:hi] /= words
            own, place = self._placed(self.hashes, 0, row, h)
            both, n = np.unique(own * len(self.hashes) + place, return_counts=True)
            row = both // len(self.hashes)
            rows.append(row + lo)
            terms.append(both % len(self.hashes))
            counts.append(n / words[row])
        return (np.concatenate(rows), np.concatenate(terms), np.concatenate(counts)), density

    def _placed(self, hashes: np.ndarray, which: int, row: np.ndarray, h: np.ndarray):
        """Rows and places of the hashes that are among the sorted ones."""
        maybe = self.filters[which][(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]
        row, h = row[maybe], h[maybe]
        place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        ok = hashes[place] == h
        return row[ok], place[ok]


def _first_of_copies(
    sample: Sample, alike: tuple[int, int] = (4, 5), width: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the sample without near copies of an earlier one of the same label, and
    their weights, those of their copies included.

    Near copies are equal texts, or texts whose sets of shingles of ``width`` words are
    ``alike`` or more. Such sets share one of their rarest shingles, of which each set
    has as many as the other may lack, and one more; pairs that do are compared. Shingles
    that one set alone holds need no place in the index."""
    top, bottom = alike
    raw, offsets = text_bytes(pa.array(sample.texts, pa.string()))
    sets: list[np.ndarray] = []
    for lo, hi in blocks(offsets, _BLOCK_BYTES):
        part = raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        values, edge = shingle_sets(*part, width)
        sets += [values[a:b] for a, b in zip(edge.tolist(), edge[1:].tolist())]
    # Only shingles of several sets, and how many sets hold them.
    every = np.concatenate([np.zeros(0, np.uint64), *sets])
    every.sort()
    known, often = np.unique(every[1:][every[1:] == every[:-1]], return_counts=True)
    del every
    weights = sample.weights.astype(float)
    texts: dict[tuple, int] = {}
    seen: dict[tuple, list[int]] = {}
    kept = []
    for i, own in enumerate(sets):
        label = int(sample.labels[i])
        first = texts.setdefault((label, sample.texts[i]), i)
        rare: list[int] = []
        if first == i and len(own):
            held = np.ones(len(own), np.int64)
            if len(known):
                place = np.minimum(np.searchsorted(known, own), len(known) - 1)
                held += np.where(known[place] == own, often[place], 0)
            rarest = np.argsort(held, kind="stable")
            rarest = rarest[: len(own) - -(-top * len(own) // bottom) + 1]
            rare = own[rarest[held[rarest] > 1]].tolist()
            for j in sorted({j for x in rare for j in seen.get((label, x), ())}):
                few, many = sorted((len(own), len(sets[j])))
                if bottom * few < top * many:
                    continue
                shared = np.intersect1d(own, sets[j], assume_unique=True).size
                if bottom * shared >= top * (few + many - shared):
                    first = texts[label, sample.texts[i]] = j
                    break
        if first != i:
            weights[first] += weights[i]
            continue
        kept.append(i)
        for x in rare:
            seen.setdefault((label, x), []).append(i)
    places = np.array(kept, np.int64)
    return places, weights[places]


def _words(texts: pa.Array) -> np.ndarray:
    """Hashes of all words of the texts."""
    raw, offsets = _lower(texts)
    found = [np.zeros(0, np.uint64)]
    for lo, hi in blocks(offsets, _BLOCK_BYTES):
        at = offsets[lo : hi + 1] - offsets[lo]
        found.append(np.unique(next(_terms(raw[offsets[lo] : offsets[hi]], at))[1]))
    return np.unique(np.concatenate(found))


def _significant(
    texts: pa.Array, labels: np.ndarray, most: int, least_gain: float, least_held: int = 3
) -> np.ndarray:
    """Hashes of the terms that label 1 holds more often, by the G statistic."""
    raw, offsets = _lower(texts)
    n = [int((labels == value).sum()) for value in (0, 1)]
    if not min(n):
        return np.zeros(0, np.uint64)
    # Label 1 first; of label 0 only the terms that are left are counted.
    values, one = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for h in _held(raw, offsets, labels == 1):
        both, place = np.unique(np.concatenate([values, h]), return_inverse=True)
        one = np.bincount(place[: len(values)], one, len(both)) + np.bincount(
            place[len(values) :], minlength=len(both)
        )
        values = both
    often = one >= least_held
    values, one = values[often], one[often].astype(float)
    zero = np.zeros(len(one))
    if not len(values):
        return values
    for h in _held(raw, offsets, labels == 0):
        place = np.minimum(np.searchsorted(values, h), len(values) - 1)
        zero += np.bincount(place[values[place] == h], minlength=len(values))
    total = one + zero
    gain = np.zeros(len(one))
    for observed, size in ((one, n[1]), (zero, n[0])):
        for part, expected in (
            (observed, total * size / sum(n)),
            (size - observed, (sum(n) - total) * size / sum(n)),
        ):
            some = part > 0
            gain[some] += 2 * part[some] * np.log(part[some] / expected[some])
    ok = np.flatnonzero((gain >= least_gain) & (one / n[1] > zero / n[0]))
    ok = ok[np.argsort(-gain[ok], kind="stable")][:most]
    return np.sort(values[ok])


def _held(raw: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> Iterator[np.ndarray]:
    """The terms of the texts asked for, each once per text, block by block."""
    for lo, hi in blocks(offsets, _BLOCK_BYTES):
        at = offsets[lo : hi + 1] - offsets[lo]
        parts = [*_terms(raw[offsets[lo] : offsets[hi]], at)]
        row = np.concatenate([r for r, _ in parts])
        h = np.concatenate([x for _, x in parts])
        own = which[row + lo]
        row, h = row[own], h[own]
        order = np.lexsort([h, row])
        row, h = row[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
        yield h[new]


@dataclass
class Index:
    """Unit vectors of the examples, searched for their largest cosines.

    What goes to the tasks are the vectors; block maxima and posting lists are made from
    them where they are used. ``looked`` and ``skipped`` count the blocks of this process.
    """

    ids: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    idf: np.ndarray
    common: int = 16

    def build(self, rows: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> Index:
        """Vectors by example."""
        n = len(self.ids)
        weight, _ = self.unit(rows, terms, counts, n)
        by = np.lexsort([terms, rows])
        self.terms, self.weight = terms[by].astype(np.int32), weight[by]
        self.at = np.searchsorted(rows[by], np.arange(n + 1))
        self.looked = self.skipped = 0
        return self

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _prepared(self) -> None:
        """Lists by term: a term that at least one in ``common`` examples holds has a dense
        one in blocks, with their maxima, and its weights in double precision by example;
        any other has a plain one."""
        if hasattr(self, "_blocks"):
            return
        n, terms, weight = len(self.ids), self.terms, self.weight
        rows = row_of(self.at).astype(np.int32)
        held = np.bincount(terms, minlength=len(self.idf) + 1)
        often = np.flatnonzero(self.common * held >= max(n, 1))
        self._dense_row = np.full(len(held), -1, np.int32)
        self._dense_row[often] = np.arange(len(often))
        # Examples in blocks of like ones; places past the last one hold nothing.
        own = self._dense_row[terms] >= 0
        row, held_by = self._dense_row[terms[own]], rows[own]
        order = _alike(held_by, row, weight[own], n, len(often))
        n_blocks = -(-n // _WIDTH)
        self._order = np.append(order, np.full(n_blocks * _WIDTH - n, -1))
        self._place = np.empty(n, np.int64)
        self._place[order] = np.arange(n)
        place = self._place[held_by]
        self._blocks = np.zeros((n_blocks, len(often), _WIDTH), np.float32)
        self._blocks[place // _WIDTH, row, place % _WIDTH] = weight[own]
        self._maxima = np.ascontiguousarray(self._blocks.max(axis=2).T)
        self._exact = np.zeros((n, len(often)))
        self._exact[place, row] = weight[own]
        terms, weight, place = terms[~own], weight[~own], self._place[rows[~own]]
        by = np.lexsort([place, terms])
        self._post_place, self._post_weight = place[by], weight[by]
        self._post_at = np.searchsorted(terms[by], np.arange(len(held) + 1))
        del rows, held, own, row, held_by, place, terms, weight, by
        give_back()

    def unit(self, rows, terms, counts, n) -> tuple[np.ndarray, np.ndarray]:
        """Weights of the terms of n unit vectors, and of a component beside the terms,
        which none of them has."""
        weight = counts * self.idf[terms]
        norm = np.sqrt(np.bincount(rows, weight * weight, minlength=n))
        return weight / norm[rows], np.zeros(n)

    def nearest(
        self, terms: np.ndarray, weight: np.ndarray, k: int, leave: int = -1
    ) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples; ``leave`` is one to leave out."""
        at = np.array([0, len(terms)])
        return self.nearest_of_each(at, terms, weight, k, np.array([leave]))[0]

    def nearest_of_each(
        self, at: np.ndarray, terms: np.ndarray, weight: np.ndarray, k: int, leave: np.ndarray
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """The same for a batch of queries, the terms of each from ``at`` on."""
        self._prepared()
        m, query = len(at) - 1, row_of(at)
        n = len(self._order)
        row = self._dense_row[terms]
        own = row >= 0
        common = np.zeros((m, len(self._maxima)))
        common[query[own], row[own]] = weight[own]
        own = np.flatnonzero(~own)
        begin = self._post_at[terms[own]]
        size = self._post_at[terms[own] + 1] - begin
        edge = np.append(0, np.cumsum(size))
        begin -= edge[:-1]
        cut = np.searchsorted(own, at)
        # Query by query: what a query reads of the lists stays small enough for a cache.
        rare = np.zeros((m, n))
        for q in range(m):
            mine = slice(cut[q], cut[q + 1])
            place = np.repeat(begin[mine], size[mine])
            if len(place):
                place += np.arange(edge[cut[q]], edge[cut[q + 1]])
                product = np.repeat(weight[own[mine]], size[mine])
                product *= self._post_weight[place]
                rare[q] = np.bincount(self._post_place[place], product, n)
        rare = rare.reshape(m, -1, _WIDTH)
        out = np.full(m, -1)
        out[leave >= 0] = self._place[leave[leave >= 0]]
        score, least = self._pruned(common.astype(np.float32), rare, k, out)
        found = []
        for q in range(m):
            place = np.flatnonzero(score[q] >= least[q])
            near = self._order[place]
            cosine = (self._exact[place] * common[q]).sum(axis=1) + rare[q].reshape(-1)[place]
            cosine = np.round(cosine, 12)
            by = np.lexsort([self.ids[near], -cosine])[:k]
            found.append((near[by], cosine[by]))
        return found

    def _pruned(
        self, part: np.ndarray, rare: np.ndarray, k: int, out: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Products of every query with the examples of the blocks that may hold one of its
        k nearest, -1 elsewhere and for the example to leave out; and the least product
        that one of the k may have."""
        m, n_blocks, _ = rare.shape
        score = np.full(rare.shape, -1.0, np.float32)
        # Two products of unit vectors are off by this at most, each by half of it.
        slack = 2 * (len(self._maxima) + 8) * 2.0**-24 + 1e-9
        bound = part @ self._maxima + rare.max(axis=2) + slack
        best = np.full((m, k), -1.0, np.float32)
        least = best[:, 0].copy()  # of the k best of each query
        left = np.ones((m, n_blocks), bool)
        left_out = np.where(out >= 0, out // _WIDTH, -1)

        def look(b: int, which: np.ndarray) -> None:
            got = part[which] @ self._blocks[b]
            got = (got + rare[which, b]).astype(np.float32)
            own = np.flatnonzero(left_out[which] == b)
            got[own, out[which[own]] % _WIDTH] = -1
            score[which, b] = got
            left[which, b] = False
            better = np.flatnonzero(got.max(axis=1) > least[which])
            if len(better):
                own = which[better]
                both = np.concatenate([best[own], got[better]], axis=1)
                both.partition(both.shape[1] - k, axis=1)
                best[own] = both[:, -k:]
                least[own] = both[:, -k]
            self.looked += len(which)

        first = np.argsort(-bound, axis=1)[:, :2]
        for b in np.unique(first).tolist():
            look(b, np.flatnonzero((first == b).any(axis=1)))
        for b in np.argsort(-bound.max(axis=0)).tolist():
            which = np.flatnonzero(left[:, b] & (bound[:, b] >= least - slack))
            if len(which):
                look(b, which)
        self.skipped += int(left.sum())
        return score.reshape(m, -1), np.maximum(least - slack, 1e-30)

    def vote(self, best: np.ndarray, cosine: np.ndarray, lexical: float) -> float:
        """Share of label 1 among neighbours and the lexicon's vote; a nearer neighbour and
        a rarer label count more."""
        w = self.weights[best] * _nearness(cosine)
        trust = self.weights.mean() * _nearness(_TRUST)
        return float(((w * self.labels[best]).sum() + trust * lexical) / (w.sum() + trust))


def _nearness(cosine):
    return cosine / (1.001 - cosine)


def _alike(rows: np.ndarray, terms: np.ndarray, weight: np.ndarray, n: int, width: int) -> np.ndarray:
    """An order of n sparse rows in which like ones stand together: halved by the median
    along one leading direction after the other."""
    axes = np.cos(np.arange(n)[:, None] * np.arange(1, _AXES + 1) + 0.5)
    for _ in range(4 if n >= _AXES else 0):
        by_term = [np.bincount(terms, weight * x[rows], minlength=width) for x in axes.T]
        by_row = [np.bincount(rows, weight * x[terms], minlength=n) for x in by_term]
        axes = np.linalg.qr(np.stack(by_row, axis=1))[0]
    parts, axis = [np.arange(n)], 0
    while len(parts[0]) > _WIDTH:
        halves = []
        for part in parts:
            part = part[np.argsort(axes[part, axis % axes.shape[1]], kind="stable")]
            half = len(part) // 2
            halves += [part[:half], part[half:]]
        parts, axis = halves, axis + 1
    return np.concatenate(parts)


@dataclass
class Model:
    vocabulary: Vocabulary
    index: Index
    lexical: tuple[float, ...]
    curve: tuple[float, ...]
    base: float
    k: int

    def score(self, texts: pa.Array) -> tuple[np.ndarray, list[list], list[list[float]]]:
        """Scores, and ids and cosines of the neighbours, some texts at a time."""
        parts = [self._score(own) for own in _slices(texts)]
        ids, cosines = ([x for p in parts for x in p[i]] for i in (1, 2))
        return np.concatenate([np.zeros(0), *[p[0] for p in parts]]), ids, cosines

    def _score(self, texts: pa.Array) -> tuple[np.ndarray, list[list], list[list[float]]]:
        found, density = self.vocabulary.scan(texts, lexicon=True)
        out = np.full(len(texts), self.base)
        ids: list[list] = [[] for _ in range(len(texts))]
        cosines: list[list[float]] = [[] for _ in range(len(texts))]
        lexical = _curve(self.lexical, _dense(density))
        for r, best, cosine in _searches(self.index, *found, len(texts), self.k):
            if len(best):
                out[r] = _curve(self.curve, self.index.vote(best, cosine, lexical[r]))
                ids[r], cosines[r] = self.index.ids[best].tolist(), cosine.tolist()
        return out, ids, cosines


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    for lo in range(0, len(texts), _TEXTS):
        yield texts.slice(lo, _TEXTS)


def _searches(index: Index, rows, terms, counts, n: int, k: int):
    if not len(rows) or not len(index.ids):
        return
    weight, _ = index.unit(rows, terms, counts, n)
    having = np.unique(rows)
    for lo in range(0, len(having), _QUERIES):
        own = having[lo : lo + _QUERIES]
        at = np.searchsorted(rows, np.append(own, own[-1] + 1))
        part = slice(at[0], at[-1])
        none = np.full(len(own), -1)
        best = index.nearest_of_each(at - at[0], terms[part], weight[part], k, none)
        for r, (places, cosine) in zip(own.tolist(), best):
            yield r, places, cosine


def _curve(curve: tuple[float, ...], x):
    return 1 / (1 + np.exp(-np.clip(curve[0] * x + curve[1], -500, 500)))


def _dense(density: np.ndarray) -> np.ndarray:
    return np.log1p(_SCALE * density)


def _votes(shared):
    """The vote on each example of those near it, itself left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back(others=True)
        index, lexical, k = shared.value
        for batch in batches:
            places, votes = [], []
            every = batch.column("id").to_numpy()
            for lo in range(0, len(every), _QUERIES):
                own = every[lo : lo + _QUERIES]
                size = index.at[own + 1] - index.at[own]
                at = np.append(0, np.cumsum(size))
                part = np.arange(at[-1]) + np.repeat(index.at[own] - at[:-1], size)
                near = index.nearest_of_each(at, index.terms[part], index.weight[part], k, own)
                for i, (best, cosine) in zip(own.tolist(), near):
                    if len(best):
                        places.append(i)
                        votes.append(index.vote(best, cosine, lexical[i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int64()), pa.array(votes, pa.float64())], names=["i", "vote"]
            )

    return run


def _frequencies(vocabulary) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back(others=True)
        own: Vocabulary = vocabulary.value
        total, n = np.zeros(len(own.hashes), np.int64), 0
        for batch in batches:
            for texts in _slices(batch.column("text")):
                total += np.bincount(own.counts(texts)[1], minlength=len(total))
            n += batch.num_rows
        terms = np.append(-1, np.flatnonzero(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.int32()), pa.array(np.append(n, total[terms[1:]]), pa.int64())],
            names=["term", "n"],
        )

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learnable: Column,
    per_class: int = 3000,
    most_terms: int = 4000,
    least_gain: float = 25.0,
    k: int = 15,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model:
    """Fit on at most ``per_class`` labelled documents of each kind, with a lexicon of at
    most ``most_terms`` terms of a G statistic of ``least_gain`` or more."""
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, label, learnable, per_class, key, text)
    kept, weights = _first_of_copies(sample)
    texts = pa.array([sample.texts[i] for i in kept], pa.string())
    y = sample.labels[kept]
    ids = np.array([sample.ids[i] for i in kept], np.int64)
    del sample
    lexicon = _significant(texts, y, most_terms, least_gain)
    both_kinds = len(np.unique(y)) == 2
    vocabulary = Vocabulary(_words(texts) if both_kinds else np.zeros(0, np.uint64), lexicon)
    (rows, terms, counts), density = vocabulary.scan(texts, lexicon=True)
    del texts
    give_back_driver(spark)
    shared = spark.sparkContext.broadcast(vocabulary)
    found = (
        docs.select(column(docs, text, "text"))
        .mapInArrow(_frequencies(shared), "term int, n bigint")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    shared.destroy()
    frequency = np.zeros(len(vocabulary.hashes) + 1)
    frequency[found["term"].to_numpy() + 1] = found["n"].to_numpy()
    idf = np.log((frequency[0] + 1) / (frequency[1:] + 1)) + 1
    del found, frequency

    having = np.unique(rows)
    index = Index(ids[having], y[having], weights[having], idf)
    own = np.searchsorted(having, rows)
    index.build(own, terms, counts)
    del rows, terms, counts, own
    without = np.setdiff1d(np.arange(len(y)), having)
    total = weights[without].sum()
    base = float((weights * y)[without].sum() / total) if total else 0.0
    if not total and len(y):
        base = float((weights * y).sum() / weights.sum())
    lexical = curve = (0.0, -30.0)
    if len(having):
        density = _dense(density[having])
        lexical = fit_logistic(density, index.labels.astype(float), index.weights)
        shared = spark.sparkContext.broadcast((index, _curve(lexical, density), k))
        voted = spark.range(len(having)).mapInArrow(_votes(shared), "i bigint, vote double").collect()
        shared.destroy()
        if voted:
            places = np.array([r.i for r in voted], np.int64)
            votes = np.array([r.vote for r in voted])
            curve = fit_logistic(votes, index.labels[places].astype(float), index.weights[places])
    give_back_driver(spark)
    return Model(vocabulary, index, lexical, curve, base, k)


def _scorer(shared, evidence: int):
    kind = pa.struct(
        [("score", pa.float64()), ("neighbours", pa.list_(pa.int64())), ("cosines", pa.list_(pa.float64()))]
    )

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        give_back(others=True)
        for batch in texts:
            found, ids, cosines = shared.value.score(batch)
            ids, cosines = ([x[:evidence] for x in own] for own in (ids, cosines))
            parts = [pa.array(x, f.type) for x, f in zip((found, ids, cosines), kind)]
            del batch, found, ids, cosines
            yield pa.StructArray.from_arrays(parts, fields=[*kind])
            del parts
            give_back()

    return F.arrow_udf(score, "score double, neighbours array<bigint>, cosines array<double>")


def toxicity(
    docs: DataFrame,
    model: Model,
    evidence: int = 3,
    carry: list[str] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``row``, a struct of the carried columns (the key alone unless said otherwise),
    ``score``, and as evidence the ids and cosines of the nearest examples."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # Only the texts go to Python.
    source = docs.select(
        F.struct(*[column(docs, c) for c in (carry or [key])]).alias("row"),
        _scorer(shared, evidence)(column(docs, text)).alias("found"),
    )
    return source.select("row", "found.score", "found.neighbours", "found.cosines")

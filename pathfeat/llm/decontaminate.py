"""Passages of a benchmark inside documents, found by an FM-index per training shard.

Words are runs of bytes outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z is
lower-cased. A window is ``window`` consecutive words of an item; an item of fewer words,
but not none, is one window. Every occurrence of a window hits the words it covers.

A task takes the documents it reads as shards. Words that the benchmark lacks, and
neighbours that are neighbours nowhere in it, can't lie in an occurrence; what is left
of the shard, as numbers of benchmark words, goes into an FM-index with wavelet-tree
ranks. All windows are searched backwards at once, occurrences are located by sampled
suffix positions, and overlapping ones are merged into removal spans.

The benchmark is dealt into blocks of about ``block_bytes``; only one block at a time
passes through the driver and only its windows are broadcast. With several blocks the
documents go through one search after the other in the same stage, each adding its hits.

Defined results: null and empty texts have no words and no hits; a document or item with
a null id is searched, but a null item id can't be listed; repeated items count once,
repeated documents once each; an empty table gives no rows, an empty benchmark no hits;
columns other than those named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import (
    blocks,
    column,
    give_back,
    lowered,
    row_of,
    schema_after,
    span_hashes,
    text_bytes,
    word_spans,
)
from .fm_index import FMIndex

IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True

_SHARD_BYTES = 1 << 23
_BLOCK_BYTES = 1 << 19
_FILTER_BITS = 22

_STATE = "starts array<int>, ends array<int>, items array<string>"
_RESULT = (
    "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
    "items array<string>, span_starts array<int>, span_ends array<int>"
)


def _numbered_words(raw: np.ndarray, offsets: np.ndarray):
    raw = lowered(raw)
    starts, ends, first = word_spans(raw, offsets, IS_WORD)
    return span_hashes(raw, starts, ends), starts, ends, first


class _Members:
    """Which numbers of a sorted set are given, and where: most others are turned away
    by one look at a table of bits."""

    def __init__(self, members: np.ndarray) -> None:
        self.members = members
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[self._slot(members)] = True

    @staticmethod
    def _slot(x: np.ndarray) -> np.ndarray:
        mixed = x * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of each number in the set, or -1."""
        out = np.full(len(x), -1, np.int64)
        maybe = np.flatnonzero(self.seen[self._slot(x)])
        if len(maybe):
            place = np.searchsorted(self.members, x[maybe])
            place = np.minimum(place, len(self.members) - 1)
            ok = self.members[place] == x[maybe]
            out[maybe[ok]] = place[ok]
        return out


@dataclass
class Windows:
    """The distinct windows of a block of items, as numbers of its words."""

    words: np.ndarray  # sorted hashes; a word's number is its place, from 1
    patterns: np.ndarray  # one window per row, aligned to the right
    lengths: np.ndarray
    owners: list[list[str]]  # of each window, its items

    @staticmethod
    def of(items: list[tuple[str | None, str | None]], window: int) -> Windows:
        raw, offsets = text_bytes(pa.array([t for _, t in items], pa.string()))
        hashes, _, _, first = _numbered_words(raw, offsets)
        words = np.unique(hashes)
        numbers = np.searchsorted(words, hashes) + 1
        found: dict[tuple[int, ...], set[str]] = {}
        for (item, _), lo, hi in zip(items, first.tolist(), first[1:].tolist()):
            own = numbers[lo:hi].tolist()
            for at in range(max(1, len(own) - window + 1) if own else 0):
                ids = found.setdefault(tuple(own[at : at + window]), set())
                if item is not None:
                    ids.add(item)
        lengths = np.array([len(w) for w in found], np.int64)
        patterns = np.zeros((len(found), window), np.int64)
        for i, w in enumerate(found):
            patterns[i, window - len(w) :] = w
        return Windows(words, patterns, lengths, [sorted(x) for x in found.values()])

    def prepare(self) -> None:
        """Lookups of one worker process."""
        self.word_lookup = _Members(self.words)
        left, right = self.patterns[:, :-1], self.patterns[:, 1:]
        pairs = left[left > 0].astype(np.uint64) << np.uint64(32)
        pairs |= right[left > 0].astype(np.uint64)
        self.pair_lookup = _Members(np.unique(pairs))
        self.shortest = int(self.lengths.min()) if len(self.lengths) else 0


def _kept_words(windows: Windows, hashes: np.ndarray, first: np.ndarray) -> tuple:
    """Places and numbers of the words that could lie in an occurrence; -1 and 0 stand
    between stretches."""
    number = windows.word_lookup.find(hashes) + 1
    n = len(number)
    joined = np.zeros(n + 1, bool)  # with the word before
    joined[1:n] = (number[1:] > 0) & (number[:-1] > 0)
    joined[first[(first > 0) & (first < n)]] = False
    at = np.flatnonzero(joined[:n])
    pair = (number[at - 1].astype(np.uint64) << np.uint64(32)) | number[at].astype(np.uint64)
    joined[at] = windows.pair_lookup.find(pair) >= 0
    begin = np.flatnonzero(~joined[:n])
    size = np.diff(np.append(begin, n))
    ok = (number[begin] > 0) & (size >= windows.shortest)
    begin, size = begin[ok], size[ok] + 1
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    place += np.repeat(begin, size)
    edge = np.cumsum(size) - 1
    numbers = number[np.minimum(place, max(n - 1, 0))] if n else place
    numbers[edge], place[edge] = 0, -1
    return place, numbers


def search(windows: Windows, raw: np.ndarray, offsets: np.ndarray):
    """Hit words of a shard: start and end bytes of all words, the word offsets of the
    rows, a flag per word, and the pairs of row and item."""
    starts, ends, firsts, places, numbers = [], [], [np.zeros(1, np.int64)], [], []
    n = 0
    for lo, hi in blocks(offsets, _BLOCK_BYTES):
        base = offsets[lo]
        hashes, s, e, first = _numbered_words(raw[base : offsets[hi]], offsets[lo : hi + 1] - base)
        starts.append(s + base)
        ends.append(e + base)
        firsts.append(first[1:] + n)
        if len(windows.lengths):
            place, number = _kept_words(windows, hashes, first)
            places.append(np.where(place < 0, -1, place + n))
            numbers.append(number)
        n += len(s)
    cat = lambda x: np.concatenate([np.zeros(0, np.int64), *x])
    starts, ends, first, places, numbers = map(cat, (starts, ends, firsts, places, numbers))
    edges = np.zeros(n + 1, np.int64)
    pairs: set[tuple[int, str]] = set()
    if len(numbers):
        index = FMIndex(numbers, len(windows.words) + 1)
        lo, hi = index.search(windows.patterns, windows.lengths)
        found = np.flatnonzero(lo < hi)
        size = hi[found] - lo[found]
        rows = np.arange(int(size.sum())) + np.repeat(lo[found] - (np.cumsum(size) - size), size)
        which = np.repeat(found, size)
        at = places[index.locate(rows)]
        np.add.at(edges, at, 1)
        np.add.at(edges, at + windows.lengths[which], -1)
        row = np.searchsorted(first, at, "right") - 1
        both = np.unique(np.stack([row, which], axis=1), axis=0)
        pairs = {(r, item) for r, w in both.tolist() for item in windows.owners[w]}
    return starts, ends, first, np.cumsum(edges[:n]) > 0, pairs


def _spans(flags: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of hit words as first and last word, and the run offsets of the rows."""
    before = np.zeros(len(flags), bool)
    before[1:] = flags[:-1]
    before[first[first < len(flags)]] = False
    begin = np.flatnonzero(flags & ~before)
    after = np.zeros(len(flags), bool)
    after[:-1] = flags[1:]
    after[first[first > 0] - 1] = False
    end = np.flatnonzero(flags & ~after)
    return begin, end, np.searchsorted(begin, first)


def _lists(values: np.ndarray, edges: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values, kind))


def _results(texts: pa.Array, state: list[pa.Array] | None, windows: Windows, last: bool, share: int):
    """The columns of one shard: the state for the next search, or the results."""
    raw, offsets = text_bytes(texts)
    starts, ends, first, flags, pairs = search(windows, raw, offsets)
    items: list[set[str]] = [set() for _ in range(len(texts))]
    if state:
        old_start, old_end, old_items = state
        row = row_of(old_start.offsets.to_numpy())
        edges = np.zeros(len(flags) + 1, np.int64)
        np.add.at(edges, first[row] + old_start.flatten().to_numpy(), 1)
        np.add.at(edges, first[row] + old_end.flatten().to_numpy() + 1, -1)
        flags |= np.cumsum(edges[:-1]) > 0
        items = [set(x) for x in old_items.to_pylist()]
    for r, item in pairs:
        items[r].add(item)
    begin, end, runs = _spans(flags, first)
    row = row_of(runs)
    listed = pa.array([sorted(x) for x in items], pa.list_(pa.string()))
    if not last:
        own = [_lists(x - first[row], runs, pa.int32()) for x in (begin, end)]
        return [*own, listed]
    n_words = np.diff(first)
    hit_sum = np.concatenate([[0], np.cumsum(flags)])
    n_hit = hit_sum[first[1:]] - hit_sum[first[:-1]]
    none = hashlib.sha256(b"").hexdigest()
    digests = [
        hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() if x else none for x in items
    ]
    return [
        pa.array(n_words, pa.int64()),
        pa.array(n_hit, pa.int64()),
        pa.array([len(x) for x in items], pa.int64()),
        pa.array(digests, pa.string()),
        pa.array((n_hit > 0) & (share * n_hit >= n_words)),
        listed,
        _lists(starts[begin] - offsets[row], runs, pa.int32()),
        _lists(ends[end] - offsets[row], runs, pa.int32()),
    ]


def _searched(
    docs: DataFrame,
    carried: list[str],
    benchmark: DataFrame,
    window: int,
    share: int,
    block_bytes: int,
    text: str,
    item_key: str,
    item_text: str,
    keep_text: bool = False,
) -> DataFrame:
    """``row``, a struct of the carried columns, the text if asked for, and the results."""
    items = benchmark.select(
        column(benchmark, item_key).cast("string").alias("item"),
        column(benchmark, item_text, "text"),
    ).where(F.length("text") > 0).distinct()
    total = items.select(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks))
    source = docs.select(
        F.struct(*[column(docs, c) for c in carried]).alias("row"), column(docs, text, "text")
    )
    row = source.schema["row"]
    for b in range(n_blocks):
        own = [(r.item, r.text) for r in items.where(block == b).collect()]
        windows = docs.sparkSession.sparkContext.broadcast(Windows.of(own, window))
        last = b == n_blocks - 1
        fields = _RESULT if last else _STATE
        texts = keep_text or not last
        schema = schema_after(row, ("text string, " if texts else "") + fields)
        names = [f.split()[0] for f in fields.split(", ")]
        source = source.mapInArrow(_searcher(windows, b > 0, last, share, names, texts), schema)
    return source


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    share: int = 20,
    block_bytes: int = 1 << 24,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Per document ``key, n_words, n_hit, n_items, items_sha256, contaminated, items,
    span_starts, span_ends``, the spans in bytes of the text.

    A document is contaminated if it has a hit and ``share * n_hit >= n_words``.
    """
    found = _searched(docs, [key], benchmark, window, share, block_bytes, text, item_key, item_text)
    return found.select(F.col("row")[key].alias(key), *[f.split()[0] for f in _RESULT.split(", ")])


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    share: int = 20,
    block_bytes: int = 1 << 24,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` with the spans cut from the texts of contaminated documents; nothing is
    put in a span's place, and all other rows and columns stay as they are."""
    others = [c for c in docs.columns if c != text]
    found = _searched(
        docs, others, benchmark, window, share, block_bytes, text, item_key, item_text, keep_text=True
    )
    whole = F.encode("text", "utf-8")
    gaps = F.zip_with(
        F.concat(F.array(F.lit(0)), F.col("span_ends")),
        F.concat(F.col("span_starts"), F.array(F.octet_length(whole))),
        lambda a, b: F.decode(F.substr(whole, a + 1, b - a), "utf-8"),
    )
    left = F.when(F.col("contaminated"), F.array_join(gaps, "")).otherwise(F.col("text"))
    return found.select(
        *[left.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns]
    )


def _searcher(shared, stated: bool, last: bool, share: int, names: list[str], texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back(others=True)
        windows: Windows = shared.value
        windows.prepare()
        for batch in batches:
            _, offsets = text_bytes(batch.column("text"))
            for lo, hi in blocks(offsets, _SHARD_BYTES):
                part = batch.slice(lo, hi - lo)
                state = None
                if stated:
                    state = [pa.concat_arrays([part.column(c)]) for c in ("starts", "ends", "items")]
                out = _results(part.column("text"), state, windows, last, share)
                head = {"row": part.column("row")}
                if texts:
                    head["text"] = part.column("text")
                yield pa.RecordBatch.from_arrays([*head.values(), *out], names=[*head, *names])
        give_back()

    return run

"""Token ids of a byte-level BPE file of the tokenizers library, encoded piece by piece.

The library splits a text into pieces with a fixed pattern and encodes each piece for
itself, and most pieces of a corpus have been seen before. So the split is done on flat
arrays, a piece is looked up by its hash in a bounded table and compared with the piece
found there, and only pieces that are not there go through the library. Texts whose split the arrays can't state (they hold an
added token or a code point that Python's Unicode tables don't know) go through the
library whole, so the ids are the library's in every case.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from functools import cache, partial
from itertools import chain

import numpy as np

from .columns import blocks, kept_by_worker, span_hashes

_LETTER, _NUMBER, _OTHER, _SPACE, _UNKNOWN, _NONE = range(6)
# White space of the pattern's \s, as code points.
_SPACES = (
    [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
# The split pattern of byte-level BPE that the arrays below state.
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

_SLOTS = 1 << 18
_MOST_POINTS = 1 << 24
_BLOCK = 1 << 19


@cache
def _classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": _LETTER, "N": _NUMBER}
    table = np.full(0x110000, _OTHER, np.uint8)
    for c in range(0x110000):
        category = unicodedata.category(chr(c))
        if category[0] in kinds:
            table[c] = kinds[category[0]]
        elif category == "Cn":
            table[c] = _UNKNOWN
    table[_SPACES] = _SPACE
    return table


class Encoder:
    """Ids of texts by the tokenizers file at ``path``.

    ``most_pieces`` bounds the pieces that are remembered, as does the length they have
    together; beyond that the memory starts afresh. It changes the speed only.
    """

    def __init__(self, path: str, most_pieces: int = 300_000) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.most_pieces = most_pieces
        spec = json.loads(self.library.to_str())
        self.added = [x["content"] for x in spec["added_tokens"]]
        split = spec["pre_tokenizer"] or {}
        self.by_piece = (
            spec["normalizer"] is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex") is True
            and not split.get("add_prefix_space")
            and spec["model"].get("type") == "BPE"
            and not spec["model"].get("dropout")
        )
        self.pieces = _piece_encoder(self.library, spec) if self.by_piece else None
        self._forget()

    def _forget(self) -> None:
        self.entries: dict[int, int] = {}
        self.keys = np.zeros((2, _SLOTS), np.uint64)
        self.slots = np.zeros((2, _SLOTS), np.int32)
        self.begin = np.zeros(1 << 12, np.int64)
        self.count = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, np.uint16)
        self.used = 0
        # The pieces themselves, by entry.
        self.points = np.zeros(1 << 14, np.uint32)
        self.piece = np.zeros((2, 1 << 12), np.int64)
        self.n_points = self.n_entries = 0

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of UTF-8 bytes, one after the other, and n + 1 id offsets."""
        parts, counts = [], [np.zeros(1, np.int64)]
        for lo, hi in blocks(offsets, _BLOCK):
            ids, n = self._block(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            parts.append(ids)
            counts.append(n)
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        return ids.astype(np.uint32, copy=False), np.cumsum(np.concatenate(counts))

    def counts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Number of ids of every row."""
        parts = [np.zeros(0, np.int64)]
        for lo, hi in blocks(offsets, _BLOCK):
            own = raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            parts.append(self._block(*own, ids=False)[1])
        return np.concatenate(parts)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out = [np.array(x.ids, np.uint32) for x in self.library.encode_batch(texts, add_special_tokens=False)]
        n = np.array([len(x) for x in out], np.int64)
        return np.concatenate([np.zeros(0, np.uint32), *out]), n

    def _block(
        self, raw: np.ndarray, offsets: np.ndarray, ids: bool = True
    ) -> tuple[np.ndarray, np.ndarray]:
        data = raw.tobytes()
        if not self.by_piece:
            return self._whole([data[a:b].decode() for a, b in zip(offsets, offsets[1:])])
        odd = np.zeros(len(offsets) - 1, bool)
        for word in self.added:
            at = data.find(word.encode())
            while at >= 0:
                odd[np.searchsorted(offsets, at, "right") - 1] = True
                at = data.find(word.encode(), at + 1)
        leads = (raw & 0xC0) != 0x80
        places = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(leads, out=places[1:])
        at = places[offsets]  # rows in code points
        points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
        kind = _classes()[points]
        unknown = np.flatnonzero(kind == _UNKNOWN)
        if len(unknown):
            odd[np.searchsorted(at, unknown, "right") - 1] = True
        starts = self._piece_starts(points, kind, at)
        ends = np.append(starts[1:], len(points))
        entry = self._look_up(points, starts, ends)
        n = self.count[entry]
        first = np.searchsorted(starts, at)
        sums = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=sums[1:])
        of_row = np.diff(sums[first])
        out = np.zeros(0, np.uint32)
        if ids:
            place = np.arange(sums[-1]) + np.repeat(self.begin[entry] - sums[:-1], n)
            out = self.ids[place].astype(np.uint32)
        if odd.any():
            rows = np.flatnonzero(odd)
            whole, m = self._whole([data[offsets[r] : offsets[r + 1]].decode() for r in rows])
            if ids:
                edge = np.concatenate([[0], np.cumsum(of_row)])
                edge_m = np.concatenate([[0], np.cumsum(m)])
                parts, last = [], 0
                for i, r in enumerate(rows):
                    parts += [out[last : edge[r]], whole[edge_m[i] : edge_m[i + 1]]]
                    last = edge[r + 1]
                out = np.concatenate([*parts, out[last:]])
            of_row[rows] = m
        return out, of_row

    @staticmethod
    def _piece_starts(points: np.ndarray, kind: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the pieces begin: runs of one class, each with one blank before it;
        white space keeps its last character apart where more text follows."""
        n = len(points)
        if n == 0:
            return np.zeros(0, np.int64)
        row_start = np.zeros(n + 1, bool)
        row_start[at] = True
        row_start[n] = True
        before = np.empty(n, np.uint8)
        before[0] = _NONE
        before[1:] = kind[:-1]
        before[row_start[:n]] = _NONE
        after = np.empty(n, np.uint8)
        after[-1] = _NONE
        after[:-1] = kind[1:]
        after[row_start[1:]] = _NONE
        space = kind == _SPACE
        blank_before = np.zeros(n, bool)
        blank_before[1:] = points[:-1] == 32
        blank_before &= before == _SPACE
        begin = (kind != before) & (space | ~blank_before)
        begin |= space & (after != _SPACE) & (after != _NONE)
        marks = np.flatnonzero(
            (points == 39) & (before != _OTHER) & ((before != _SPACE) | ~blank_before)
        )
        for tail in _CONTRACTIONS if len(marks) else ():
            end = marks + 1 + len(tail)
            ok = end <= n
            for i, letter in enumerate(tail):
                place = np.minimum(marks + 1 + i, n - 1)
                ok &= (points[place] == ord(letter)) & ~row_start[place]
            begin[marks[ok]] = True
            begin[marks[ok] + 1] = False
            end = end[ok]
            begin[end[end < n]] = True
        begin |= row_start[:n]
        return np.flatnonzero(begin)

    def _look_up(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.entries) > self.most_pieces or self.n_points > _MOST_POINTS:
            self._forget()
        key = span_hashes(points, starts, ends)
        slot = [(key >> np.uint64(40)) & np.uint64(_SLOTS - 1), key & np.uint64(_SLOTS - 1)]
        slot = [x.astype(np.int64) for x in slot]
        entry = self.slots[0][slot[0]]
        miss = np.flatnonzero(self.keys[0][slot[0]] != key)
        if len(miss):
            second = slot[1][miss]
            entry[miss] = self.slots[1][second]
            miss = miss[self.keys[1][second] != key[miss]]
        if len(miss):
            rest, where, back = np.unique(key[miss], return_index=True, return_inverse=True)
            found = np.array([self.entries.get(k, -1) for k in rest.tolist()], np.int64)
            new = np.flatnonzero(found < 0)
            if len(new):
                found[new] = self._learn(points, starts, ends, miss[where[new]])
                self._remember(rest[new], found[new])
            entry[miss] = found[back]
        other = self._unlike(points, starts, ends, entry)
        if len(other):
            # Pieces that share a hash with another one are learnt apart from the table.
            entry[other] = self._learn(points, starts, ends, other)
        return entry

    def _unlike(self, points, starts, ends, entry) -> np.ndarray:
        """Which pieces of a block differ from their entry's. Pieces fill the block."""
        if not len(starts):
            return starts
        begin, size = self.piece[:, entry]
        place = np.arange(len(points)) + np.repeat(begin - starts, ends - starts)
        place = np.minimum(place, len(self.points) - 1)
        same = np.logical_and.reduceat(self.points[place] == points, starts)
        return np.flatnonzero(~same | (size != ends - starts))

    def _learn(self, points, starts, ends, which) -> np.ndarray:
        """New entries of some pieces."""
        starts, ends = starts[which], ends[which]
        flat, n = self.pieces(points, starts, ends)
        if len(flat) and flat.max() > 0xFFFF and self.ids.dtype == np.uint16:
            self.ids = self.ids.astype(np.uint32)
        size = ends - starts
        new = np.arange(self.n_entries, self.n_entries + len(n))
        self.begin, self.count = (_grown(x, new[-1] + 1) for x in (self.begin, self.count))
        self.piece = np.stack([_grown(x, new[-1] + 1) for x in self.piece])
        self.ids = _grown(self.ids, self.used + len(flat))
        self.points = _grown(self.points, self.n_points + int(size.sum()))
        self.begin[new] = self.used + np.cumsum(n) - n
        self.count[new] = n
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        edge = np.cumsum(size) - size
        place = np.arange(int(size.sum())) + np.repeat(starts - edge, size)
        self.points[self.n_points : self.n_points + len(place)] = points[place]
        self.piece[0, new], self.piece[1, new] = self.n_points + edge, size
        self.n_points += len(place)
        self.n_entries += len(n)
        return new

    def _remember(self, keys: np.ndarray, new: np.ndarray) -> None:
        self.entries.update(zip(keys.tolist(), new.tolist()))
        for k, where in enumerate((keys >> np.uint64(40), keys)):
            where = (where & np.uint64(_SLOTS - 1)).astype(np.int64)
            free = self.keys[k][where] == 0
            self.keys[k][where[free]] = keys[free]
            self.slots[k][where[free]] = new[free]


def _grown(x: np.ndarray, least: int) -> np.ndarray:
    """x with room for so many, its size doubled as often as that takes."""
    size = len(x)
    while size < least:
        size *= 2
    return x if size == len(x) else np.concatenate([x, np.zeros(size - len(x), x.dtype)])


@cache
def _spelling() -> dict[str, int]:
    """The byte that each printable character stands for in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _piece_encoder(library, spec: dict) -> Callable:
    """From code points and spans to the ids of all spans and their number in each. Where
    the ids follow the order of the merges, the vocabulary can be read as ranks, and the
    faster library gives the same ids."""
    byte, model = _spelling(), spec["model"]
    added = {x["content"] for x in spec["added_tokens"]}
    vocabulary = {k: i for k, i in model["vocab"].items() if k not in added}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [vocabulary.get(a + b, -1) for a, b in merges]
    bytes_first = all(vocabulary.get(c, len(byte)) < len(byte) for c in byte)
    spell = {b: c for c, b in byte.items()}

    def one(piece: str) -> list[int]:
        return [x.id for x in library.model.tokenize("".join([spell[b] for b in piece.encode()]))]

    if bytes_first and len(order) + len(byte) == len(vocabulary) and order == sorted(set(order)):
        import tiktoken

        ranks = {bytes(byte[c] for c in k): i for k, i in vocabulary.items()}
        fast = tiktoken.Encoding(
            "pieces", pat_str=r"[^\x00]+|\x00", mergeable_ranks=ranks, special_tokens={}
        )
        return partial(_by_ranks, fast, ranks[b"\0"], one)
    return partial(_one_by_one, one)


def _one_by_one(encode: Callable[[str], list[int]], points, starts, ends):
    data = points.tobytes()
    out = [
        encode(data[4 * a : 4 * b].decode("utf-32-le"))
        for a, b in zip(starts.tolist(), ends.tolist())
    ]
    n = np.array([len(x) for x in out], np.int64)
    return np.fromiter(chain.from_iterable(out), np.int64, int(n.sum())), n


def _by_ranks(fast, mark: int, one: Callable[[str], list[int]], points, starts, ends):
    """All spans in one call, each followed by a zero that the pattern splits off."""
    size = ends - starts + 1
    edge = np.cumsum(size)
    place = np.arange(edge[-1]) + np.repeat(starts - edge + size, size)
    joined = points[np.minimum(place, len(points) - 1)]
    joined[edge - 1] = 0
    if np.count_nonzero(joined == 0) > len(size):  # a span holds a zero itself
        return _one_by_one(one, points, starts, ends)
    ids = fast.encode_to_numpy(joined.tobytes().decode("utf-32-le")).astype(np.int64)
    marks = np.flatnonzero(ids == mark)
    return np.delete(ids, marks), np.diff(marks, prepend=-1) - 1


@kept_by_worker
def encoder(path: str) -> Encoder:
    """One encoder for each file and worker process."""
    return Encoder(path)

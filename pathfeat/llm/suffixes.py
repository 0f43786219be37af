"""Two-stage suffix sorting to a bounded depth, in numpy.

A suffix is of the smaller type if it is smaller than its successor, the suffix one byte
later. Only those are sorted directly; every other suffix is induced by scanning the
buckets of first symbols in order: the predecessor of each suffix scanned goes to the
end of what its own bucket holds so far. A bucket's scan is a few array operations.
"""

from __future__ import annotations

import numpy as np


def words_at(text: np.ndarray) -> np.ndarray:
    """At every place the next eight bytes as a big-endian number; zeros past the end.
    It is a view, so only what is looked up takes eight bytes."""
    padded = np.concatenate([text, np.zeros(64, np.uint8)])
    return np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))


def smaller_type(symbols: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last one is not."""
    n = len(symbols)
    out = np.zeros(n, bool)
    differs = np.flatnonzero(symbols[1:] != symbols[:-1])
    rises = symbols[differs + 1] > symbols[differs]
    # Up to the next place where it differs, a symbol's type is that place's.
    size = np.diff(differs, prepend=-1)
    out[: int(size.sum())] = np.repeat(rises, size)
    return out


def sort_suffixes(
    text: np.ndarray, ends: np.ndarray, wanted: np.ndarray, depth: int
) -> np.ndarray:
    """The wanted places in the order of the ``depth`` bytes from each of them.

    ``text`` holds pieces, ``ends`` the place one past each piece. A wanted place has
    its ``depth`` bytes inside its piece.
    """
    # A symbol 0 closes every piece, so that types and buckets never cross pieces.
    n, pieces = len(text), len(ends)
    whole = np.int32 if n + pieces < 2**31 else np.int64
    moved = np.arange(n, dtype=whole)
    moved += np.repeat(np.arange(pieces, dtype=whole), np.diff(ends, prepend=0))
    symbols = np.zeros(n + pieces, np.uint16)
    symbols[moved] = text.astype(np.uint16) + 1
    back = np.full(n + pieces, -1, whole)
    back[moved] = np.arange(n, dtype=whole)
    smaller = smaller_type(symbols)
    close = symbols == 0
    base = smaller | close

    # A suffix of the larger type needs its successors up to the next that is sorted.
    live = np.zeros(n + pieces, bool)
    live[moved[wanted]] = True
    reach = live & ~base
    while True:
        at = np.flatnonzero(reach) + 1
        at = at[~live[at]]
        if not len(at):
            break
        live[at] = True
        reach = np.zeros_like(live)
        reach[at] = True
        reach &= ~base

    direct = np.flatnonzero(live & base)
    raw = np.zeros(n + pieces, np.uint8)
    raw[moved] = text
    del moved
    words = words_at(raw)
    keys = [
        words[np.minimum(direct + at, len(words) - 1)].astype(np.uint64)
        for at in range(0, depth, 8)
    ]
    if depth % 8:
        keys[-1] = keys[-1] >> np.uint64(64 - 8 * (depth % 8))
    direct = direct[np.lexsort([*keys[::-1], symbols[direct]])]
    first = np.searchsorted(symbols[direct], np.arange(258))

    induced: dict[int, list[np.ndarray]] = {}
    order = []
    live_larger = live & ~base
    for c in range(257):
        own = induced.pop(c, [])
        wave = np.concatenate(own) if own else np.zeros(0, np.int64)
        waves = [wave]
        while len(wave):
            before = wave - 1
            before = before[before >= 0]
            wave = before[live_larger[before] & (symbols[before] == c)]
            waves.append(wave)
        bucket = np.concatenate([*waves, direct[first[c] : first[c + 1]]])
        if not len(bucket):
            continue
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[live_larger[before] & (symbols[before] > c)]
        if len(before):
            symbol = symbols[before]
            by = np.argsort(symbol, kind="stable")
            before, symbol = before[by], symbol[by]
            cut = np.flatnonzero(np.diff(symbol)) + 1
            for part, s in zip(np.split(before, cut), symbol[np.concatenate([[0], cut])].tolist()):
                induced.setdefault(s, []).append(part)
    if not order:
        return np.zeros(0, np.int64)
    places = back[np.concatenate(order)]
    is_wanted = np.zeros(n + 1, bool)
    is_wanted[wanted] = True
    return places[is_wanted[places]]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each place with the one before it in the order, up to depth."""
    out = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return out
    words = words_at(text)
    live = np.arange(1, len(order))
    for at in range(0, depth, 8):
        a, b = order[live - 1] + at, order[live] + at
        differs = words[np.minimum(a, len(words) - 1)].astype(np.uint64)
        differs ^= words[np.minimum(b, len(words) - 1)].astype(np.uint64)
        bits = np.zeros(len(live), np.int64)
        some = differs != 0
        # The highest differing byte, counted from the front.
        for k in range(8):
            bits += (differs >> np.uint64(64 - 8 * (k + 1))) == 0
        out[live] = at + bits
        live = live[~some]
        if not len(live):
            break
    return np.minimum(out, depth)

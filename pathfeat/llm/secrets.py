"""Secrets in texts, with weak candidates reported only where their parts meet.

Three kinds are reported wherever they stand: ``assign`` (a named secret with a value of
6 or more characters), ``access`` (an access identifier of 20 or more) and ``hex`` (24 or
more lower-case hexadecimal digits). Three more are too weak alone:

    ident     a named user, account or access key, or an access identifier cut short
    opaque    16 or more characters of base 64 with a letter, a digit and ``varied``
              different characters
    endpoint  an address with its scheme, or a named host

A credential is an identifier and a secret, often with the endpoint they are for. Its
parts stand close together: in one scope, a stretch of text without a blank line, at most
``reach`` code points apart. An interval join within the scopes decides: an ident is
reported beside a secret (``assign``, ``hex`` or ``opaque``), an opaque run beside an
identifier (``access`` or ``ident``) or an endpoint, an endpoint beside an identifier and
a secret. Weak candidates that overlap a strong span are left out, and opaque runs that
overlap an ident or an endpoint: one text is not two parts. The join is a sorted search per text, without a pair of parts being formed, so a text that holds nothing but
parts costs no more than its length.

Everything about a text is in its row, so nothing is shuffled and no source, id or
common text gathers rows anywhere.

Defined results: a null or empty text has no spans; repeated rows and rows without an id
are each searched; of spans that start together the kinds' order above decides; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import blocks, column, text_bytes, word_spans

STRONG = ("assign", "access", "hex")
WEAK = ("ident", "opaque", "endpoint")
KINDS = STRONG + WEAK

# The names that a secret, an identifier and a host are given by, and the
# least length of each kind.
SECRET_NAMES = "password|passwd|secret|token|api_?key"
IDENT_NAMES = "username|user|login|account|client_?id|access_?key_?id|access_?key"
HOST_NAMES = "hostname|host|endpoint|server"
LEAST = {"assign": 6, "access": 20, "hex": 24, "ident": 3, "short_access": 8, "opaque": 16}

_GIVEN = rb"""["']?\x20*[:=]\x20*["']?"""
_ASSIGN = re.compile(
    rb"(?i:" + SECRET_NAMES.encode() + rb")" + _GIVEN + rb"([A-Za-z0-9+/_.=-]+)"
)
_NAMED = re.compile(
    rb"(?i:(" + IDENT_NAMES.encode() + rb")|" + HOST_NAMES.encode() + rb")"
    + _GIVEN + rb"([A-Za-z0-9+/_.=@-]+)"
)
_ADDRESS = re.compile(rb"[A-Za-z][A-Za-z0-9+.-]{0,15}://[\x21\x23-\x26\x28-\x3B\x3D\x3F-\x7E]+")
_BLANK_LINE = re.compile(rb"\n[\x20\x09\x0D]*\n")
_BLOCK_BYTES = 1 << 21


def _class(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(characters, np.uint8)] = True
    return out


_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"
_IS_HEX = _class(_DIGITS + b"abcdef")
_IS_ACCESS = _class(_UPPER + _DIGITS)
_IS_DIGIT = _class(_DIGITS)
_IS_LETTER = _class(_UPPER + _UPPER.lower())
_IS_OPAQUE = _class(_UPPER + _UPPER.lower() + _DIGITS + b"+/_=-")

Spans = tuple[np.ndarray, np.ndarray]


def _array(found: list[tuple[int, int]]) -> Spans:
    both = np.array(found, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _runs(raw: np.ndarray, offsets: np.ndarray, is_in: np.ndarray, least: int) -> Spans:
    starts, ends, _ = word_spans(raw, offsets, is_in)
    long = ends - starts >= least
    return starts[long], ends[long]


def _access(raw: np.ndarray, offsets: np.ndarray) -> Spans:
    """From the first AKIA of each run of capitals and digits to the run's end."""
    starts, ends = _runs(raw, offsets, _IS_ACCESS, LEAST["short_access"])
    marks = np.flatnonzero(
        (raw[:-3] == 65) & (raw[1:-2] == 75) & (raw[2:-1] == 73) & (raw[3:] == 65)
    )
    if not len(marks) or not len(starts):
        return starts[:0], ends[:0]
    at = np.searchsorted(marks, starts)
    mark = marks[np.minimum(at, len(marks) - 1)]
    own = (at < len(marks)) & (ends - mark >= LEAST["short_access"])
    return mark[own], ends[own]


def _opaque(raw: np.ndarray, offsets: np.ndarray, varied: int) -> Spans:
    """Runs of base 64 with a letter, a digit and enough different characters."""
    starts, ends = _runs(raw, offsets, _IS_OPAQUE, LEAST["opaque"])
    digits, letters = (np.append(0, np.cumsum(x[raw])) for x in (_IS_DIGIT, _IS_LETTER))
    mixed = (digits[ends] > digits[starts]) & (letters[ends] > letters[starts])
    starts, ends = starts[mixed], ends[mixed]
    if not len(starts):
        return starts, ends
    # One row of 256 marks per run; runs are few beside the bytes they are made of.
    size = ends - starts
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    cell = np.repeat(np.arange(len(size)) * 256, size) + raw[np.repeat(starts, size) + place]
    different = np.bincount(np.unique(cell) // 256, minlength=len(size))
    return starts[different >= varied], ends[different >= varied]


def _near(a: Spans, b: Spans, low: np.ndarray, high: np.ndarray, reach: int) -> np.ndarray:
    """Which spans of ``a`` have one of ``b`` in the same scope at most ``reach`` away.

    ``low`` and ``high`` are the scopes of ``a``. Of the spans of ``b`` that start before
    the window's end, the one that reaches furthest tells whether any is in it: those of
    earlier scopes end before the window begins.
    """
    if not len(b[0]) or not len(a[0]):
        return np.zeros(len(a[0]), bool)
    order = np.argsort(b[0], kind="stable")
    starts, furthest = b[0][order], np.maximum.accumulate(b[1][order])
    begin = np.maximum(low, a[0] - reach)
    upto = np.searchsorted(starts, np.minimum(high - 1, a[1] + reach), "right")
    # A span that ends where the window begins is in reach, but not one of an earlier scope.
    last = furthest[np.maximum(upto - 1, 0)]
    return (upto > 0) & (last >= begin) & (last > low)


def _overlaps(a: Spans, b: Spans) -> np.ndarray:
    if not len(b[0]) or not len(a[0]):
        return np.zeros(len(a[0]), bool)
    order = np.argsort(b[0], kind="stable")
    starts, furthest = b[0][order], np.maximum.accumulate(b[1][order])
    before = np.searchsorted(starts, a[1], "left")
    return (before > 0) & (furthest[np.maximum(before - 1, 0)] > a[0])


def _joined(*parts: Spans) -> Spans:
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _linked(
    found: dict[str, Spans], scopes: np.ndarray, reach: int
) -> dict[str, Spans]:
    """The strong spans, and the weak ones with complementary parts in reach."""
    strong = _joined(*[found[k] for k in STRONG])
    weak = {k: tuple(x[~_overlaps(found[k], strong)] for x in found[k]) for k in WEAK}
    other = _joined(weak["ident"], weak["endpoint"])
    weak["opaque"] = tuple(x[~_overlaps(weak["opaque"], other)] for x in weak["opaque"])
    identifiers = _joined(found["access"], weak["ident"])
    secrets = _joined(found["assign"], found["hex"], weak["opaque"])

    def near(a: Spans, b: Spans) -> np.ndarray:
        scope = np.searchsorted(scopes, a[0], "right")
        return _near(a, b, scopes[scope - 1], scopes[scope], reach)

    own = {
        "ident": near(weak["ident"], secrets),
        "opaque": near(weak["opaque"], identifiers) | near(weak["opaque"], weak["endpoint"]),
        "endpoint": near(weak["endpoint"], identifiers) & near(weak["endpoint"], secrets),
    }
    return {k: found[k] if k in STRONG else tuple(x[own[k]] for x in weak[k]) for k in KINDS}


def _search(
    raw: np.ndarray, offsets: np.ndarray, reach: int, varied: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, kind, start and end of the spans of some texts, in order; in code points."""
    text = raw.tobytes()
    assign, named, hosts = [], [], []
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        for m in _ASSIGN.finditer(text, lo, hi):
            if m.end(1) - m.start(1) >= LEAST["assign"]:
                assign.append(m.span())
        for m in _NAMED.finditer(text, lo, hi):
            if m.end(2) - m.start(2) >= LEAST["ident"]:
                (named if m.group(1) else hosts).append(m.span())
        if text.find(b"://", lo, hi) >= 0:
            hosts += [m.span() for m in _ADDRESS.finditer(text, lo, hi)]
    access = _access(raw, offsets)
    whole = access[1] - access[0] >= LEAST["access"]
    found = {
        "assign": _array(assign),
        "access": (access[0][whole], access[1][whole]),
        "hex": _runs(raw, offsets, _IS_HEX, LEAST["hex"]),
        "ident": _joined(_array(named), (access[0][~whole], access[1][~whole])),
        "opaque": _opaque(raw, offsets, varied),
        "endpoint": _array(sorted(set(hosts))),
    }
    # Code points before each byte.
    point = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=point[1:])
    blank = np.array([m.start() + 1 for m in _BLANK_LINE.finditer(text)], np.int64)
    scopes = point[np.unique(np.concatenate([offsets, blank]))]
    if len(scopes) < 2:
        scopes = np.array([0, 1])
    found = {k: (point[s], point[e]) for k, (s, e) in found.items()}
    linked = _linked(found, np.unique(scopes), reach)
    starts, ends = _joined(*[linked[k] for k in KINDS])
    kinds = np.repeat(np.arange(len(KINDS)), [len(linked[k][0]) for k in KINDS])
    order = np.lexsort([ends, kinds, starts])
    starts, ends, kinds = starts[order], ends[order], kinds[order]
    begins = point[offsets]
    # Empty texts begin where the next one does; a span is in the last that does.
    rows = np.searchsorted(begins[:-1], starts, "right") - 1
    return rows, kinds, starts - begins[rows], ends - begins[rows]


def _spans(reach: int, varied: int):
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    names = pa.array(KINDS)

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            raw, offsets = text_bytes(batch)
            parts = [[np.zeros(0, np.int64)] for _ in range(4)]
            for lo, hi in blocks(offsets, _BLOCK_BYTES):
                own = offsets[lo : hi + 1] - offsets[lo]
                rows, *rest = _search(raw[offsets[lo] : offsets[hi]], own, reach, varied)
                for have, new in zip(parts, (rows + lo, *rest)):
                    have.append(new)
            rows, kinds, starts, ends = (np.concatenate(p) for p in parts)
            at = np.searchsorted(rows, np.arange(len(batch) + 1))
            values = pa.StructArray.from_arrays(
                [names.take(pa.array(kinds)), pa.array(starts), pa.array(ends)], fields=[*item]
            )
            yield pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)

    return F.arrow_udf(run, "array<struct<kind:string,start:bigint,end:bigint>>")


def secret_spans(
    docs: DataFrame,
    reach: int = 160,
    varied: int = 8,
    carry: list[str] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``row``, a struct of the carried columns (the key alone unless said otherwise), and
    ``spans``, an array of ``kind, start, end`` in code points, the end exclusive."""
    row = F.struct(*[column(docs, c) for c in (carry or [key])]).alias("row")
    return docs.select(row, _spans(reach, varied)(column(docs, text)).alias("spans"))


def span_text(spans: F.Column) -> F.Column:
    """``kind:start:end`` of every span, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def span_digest(found: DataFrame) -> DataFrame:
    """Counts of the strong kinds, the digest of their spans, and all spans as text."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*STRONG))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "row",
        *[count(kind).alias(f"n_{kind}") for kind in STRONG],
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )

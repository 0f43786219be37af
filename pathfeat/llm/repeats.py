"""Byte strings that documents share with earlier ones, found by suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts in a document
with a smaller id. Strings are judged on the texts as given; they never cross documents.

1. The strings that start at neighbouring places mostly share the same least hash of
   their 16-byte parts, so a document falls into short runs of starts with one such key.
   Equal strings have equal keys. A key goes to its shard once per group of documents,
   with the number of its runs; shards answer which keys more than one document holds,
   and which of them are crowded: have more than ``most_runs`` runs in all.
2. The runs with such keys are sent to their shards with the bytes they need. Runs of a
   crowded key, those around a common phrase, are cut into single starts first, and dealt
   by the hash of their whole string. Equal runs of a group are settled inside it, and
   only those of its least document are sent, so copies cost a shard one run per group.
3. A shard sorts the suffixes of its runs in two stages (see ``suffixes``), computes
   adjacent common prefixes, and marks the strings whose least document is another one.
4. Every document's marks are merged and its text is cut.

The documents are dealt by their id and text into groups of about ``group_bytes``, and
the groups are read by three of these steps from one shuffle. The number of shards is that
of ``shard_bytes`` in the input, so neither grows with the input, but for rows that are equal
in id and text, and for equal strings, of which each group sends those of one document. Every
group may send a message to every shard, so groups are larger than shards, which sort. Rows
without an id are cut, that is, kept whole, where they are read.

Defined results: a null text is empty, and texts shorter than ``length`` keep all bytes;
a row without an id loses nothing and takes nothing from others; rows that repeat an id
take nothing from each other; an empty table gives no rows; other columns are ignored or
carried whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import blocks, column, give_back, mixed, row_of, schema_after, span_hashes, text_bytes
from .suffixes import common_prefixes, sort_suffixes

_PART = 16
_BLOCK_BYTES = 1 << 18
_LOW = np.uint64(0xFFFFFFFF)
_CODEC = "zstd"
_MOST = np.iinfo(np.uint16).max

_KEYS = "shard int, grp int, keys binary, several binary, runs binary"
_ANSWERS = "shard int, grp int, keys binary, crowded binary"
_SENT = "shard int, grp int, settled boolean, payload binary, size bigint"
_MARKS = "grp int, payload binary, size bigint"


def _runs(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of starts with one key: row, first and last start in the row, key."""
    out: list[list[np.ndarray]] = [[], [], [], []]
    for lo, hi in blocks(offsets, _BLOCK_BYTES):
        at = offsets[lo : hi + 1] - offsets[lo]
        data = np.ascontiguousarray(raw[offsets[lo] : offsets[hi]])
        n = len(data) - length + 1
        if n <= 0:
            continue
        words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)).astype(np.uint64)
        part = words[: len(data) - _PART + 1] * np.uint64(0x9FB21C651E98DF25)
        part ^= part >> np.uint64(35)
        part += words[8:]
        part *= np.uint64(0xD6E8FEB86659FD93)
        part ^= part >> np.uint64(32)
        part *= np.uint64(0xD6E8FEB86659FD93)
        least, span, width = part, 1, length - _PART + 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            rest = width - span
            least = np.minimum(least[:-rest], least[rest:])
        new = np.ones(n, bool)
        new[1:] = least[1:] != least[:-1]
        row_starts = at[:-1]
        new[row_starts[row_starts < n]] = True
        row_last = at[1:] - length  # last start of each row
        stops = row_last[(row_last >= row_starts) & (row_last + 1 < n)] + 1
        new[stops] = True
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], n) - 1
        row = np.searchsorted(at, begin, "right") - 1
        ok = end <= row_last[row]
        begin, end, row = begin[ok], end[ok], row[ok]
        for store, x in zip(
            out, (row + lo, begin - at[row], end - at[row], mixed(least[begin]))
        ):
            store.append(x)
    kinds = (np.int64, np.int64, np.int64, np.uint64)
    return tuple(np.concatenate([np.zeros(0, k), *x]) for k, x in zip(kinds, out))


def _shards_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _sorted_rows(table: pa.Table) -> pa.Table:
    """The rows of a group in one order, whatever order they came in."""
    indices = pa.compute.sort_indices(table, sort_keys=[("key", "ascending"), ("text", "ascending")])
    return table.take(indices)


def _with_ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets and ids of the rows."""
    raw, offsets = text_bytes(table.column("text"))
    return raw, offsets, table.column("key").to_numpy().astype(np.int64)


def _key_sender(length: int, shards: int):
    def run(table: pa.Table) -> pa.Table:
        give_back(others=True)
        raw, offsets, ids = _with_ids(table)
        row, first, final, keys = _runs(raw, offsets, length)
        shard = _shards_of(keys, shards)
        low = keys & _LOW
        order = np.lexsort([ids[row], low, shard])
        shard, low, owner = shard[order], low[order], ids[row][order]
        new = np.ones(len(low), bool)
        new[1:] = (shard[1:] != shard[:-1]) | (low[1:] != low[:-1])
        at = np.flatnonzero(new)
        several = np.zeros(0, bool)
        if len(at):
            last = np.append(at[1:], len(low)) - 1
            several = owner[at] != owner[last]
        # Of each key, the runs that would be sent; a long one counts as several.
        of_key = np.empty(len(order), np.int64)
        of_key[order] = np.cumsum(new) - 1
        more = np.flatnonzero(np.bincount(of_key)[of_key] > 1)
        weight = -(-(final - first + 1) // (length - _PART + 1))
        content = _content(raw, offsets, row[more], first[more], final[more], length)
        weight[more[_later(ids[row[more]], content)]] = 0
        runs = np.minimum(np.bincount(of_key, weight, len(at)), _MOST).astype(np.uint16)
        shard, low = shard[at], low[at].astype(np.uint32)
        cut = np.flatnonzero(np.diff(shard, prepend=-1))
        edges = np.append(cut, len(shard)).tolist()
        grp = table.column("grp")[0].as_py()
        rows = [
            (
                int(shard[a]),
                grp,
                low[a:b].tobytes(),
                np.packbits(several[a:b]).tobytes(),
                runs[a:b].tobytes(),
            )
            for a, b in zip(edges, edges[1:])
        ]
        return _table(rows, [pa.int32(), pa.int32(), *[pa.binary()] * 3], _KEYS)

    return run


def _table(rows: list[tuple], kinds: list[pa.DataType], schema: str) -> pa.Table:
    names = [f.split()[0] for f in schema.split(", ")]
    columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
    return pa.Table.from_arrays(columns, names=names)


def _answer(most_runs: int):
    """For each group the keys of this shard that more than one document holds, and
    which of them have more than ``most_runs`` runs."""

    def run(table: pa.Table) -> pa.Table:
        give_back(others=True)
        parts = [np.frombuffer(x, np.uint32) for x in table.column("keys").to_pylist()]
        several = np.concatenate(
            [_flags(x, len(p)) for x, p in zip(table.column("several").to_pylist(), parts)]
        )
        runs = np.concatenate(
            [np.frombuffer(x, np.uint16) for x in table.column("runs").to_pylist()]
        )
        low = np.concatenate(parts)
        values, of, count = np.unique(low, return_inverse=True, return_counts=True)
        shared = np.union1d(values[count > 1], low[several])
        crowded = values[np.bincount(of, runs) > most_runs]
        rows = []
        shard = table.column("shard")[0].as_py()
        for grp, own in zip(table.column("grp").to_pylist(), parts):
            own = own[_contains(shared, own)]
            if len(own):
                flags = np.packbits(_contains(crowded, own))
                rows.append((shard, grp, own.tobytes(), flags.tobytes()))
        return _table(rows, [pa.int32(), pa.int32(), pa.binary(), pa.binary()], _ANSWERS)

    return run


def _flags(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


def _contains(members: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(members):
        return np.zeros(len(x), bool)
    place = np.minimum(np.searchsorted(members, x), len(members) - 1)
    return members[place] == x


def _packed(arrays: list[np.ndarray]) -> tuple[bytes, int]:
    """Arrays of one length, and a last one of bytes, compressed."""
    head = np.array([len(arrays[0])], np.int64).tobytes()
    data = head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return pa.compress(data, codec=_CODEC, asbytes=True), len(data)


def _unpacked(payload: bytes, size: int, kinds: list) -> list[np.ndarray]:
    data = pa.decompress(payload, decompressed_size=size, codec=_CODEC, asbytes=True)
    n, at = int(np.frombuffer(data, np.int64, 1)[0]), 8
    out = []
    for k in kinds:
        out.append(np.frombuffer(data, k, n, at))
        at += n * np.dtype(k).itemsize
    return [*out, np.frombuffer(data, np.uint8, offset=at)]


def _run_sender(length: int, shards: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        give_back(others=True)
        kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.int64()]
        if not table.num_rows or not answers.num_rows:
            return _table([], kinds, _SENT)
        table = _sorted_rows(table)
        raw, offsets, ids = _with_ids(table)
        row, first, last, keys = _runs(raw, offsets, length)
        shard = _shards_of(keys, shards)
        full = (shard.astype(np.uint64) << np.uint64(32)) | (keys & _LOW)
        shared = [
            np.frombuffer(k, np.uint32).astype(np.uint64) | np.uint64(s << 32)
            for s, k in zip(answers.column("shard").to_pylist(), answers.column("keys").to_pylist())
        ]
        flags = [_flags(x, len(k)) for x, k in zip(answers.column("crowded").to_pylist(), shared)]
        shared, flags = np.concatenate(shared), np.concatenate(flags)
        keep = np.flatnonzero(_contains(np.sort(shared), full))
        row, first, last, shard = row[keep], first[keep], last[keep], shard[keep]

        # Runs of crowded keys are cut into single starts.
        crowded = _contains(np.sort(shared[flags]), full[keep])
        starts = np.where(crowded, last - first + 1, 1)
        of = np.repeat(np.arange(len(keep)), starts)
        step = np.arange(len(of)) - np.repeat(np.cumsum(starts) - starts, starts)
        row, shard, crowded = row[of], shard[of], crowded[of]
        first, last = first[of] + step, last[of]
        last[crowded] = first[crowded]
        content = _content(raw, offsets, row, first, last, length)
        shard[crowded] = _shards_of(content[crowded], shards)

        # Equal runs: those of a later document are settled here.
        settled = _later(ids[row], content)
        grp = table.column("grp")[0].as_py()
        rows = []
        here = np.flatnonzero(settled)
        if len(here):
            marks = [row[here], first[here], last[here] + length]
            rows.append((grp % shards, grp, True, *_packed([x.astype(np.int32) for x in marks])))
        sent = np.flatnonzero(~settled)
        sent = sent[np.argsort(shard[sent], kind="stable")]
        cut = np.flatnonzero(np.diff(shard[sent], prepend=-1))
        edges = np.append(cut, len(sent)).tolist()
        for a, b in zip(edges, edges[1:]):
            own = sent[a:b]
            size = last[own] - first[own] + length
            place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            place += np.repeat(offsets[row[own]] + first[own], size)
            arrays = [
                ids[row[own]],
                row[own].astype(np.int32),
                first[own].astype(np.int32),
                last[own].astype(np.int32),
                raw[place],
            ]
            rows.append((int(shard[own[0]]), grp, False, *_packed(arrays)))
        return _table(rows, kinds, _SENT)

    return run


def _later(ids: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Whether the same content has a smaller id."""
    order = np.lexsort([ids, content])
    same = np.zeros(len(order), bool)
    same[1:] = content[order][1:] == content[order][:-1]
    least = ids[order][np.flatnonzero(~same)]
    later = np.zeros(len(order), bool)
    later[order] = ids[order] > least[np.cumsum(~same) - 1]
    return later


def _content(raw, offsets, row, first, last, length) -> np.ndarray:
    """Hashes of the bytes of the runs, block by block."""
    out = np.zeros(len(row), np.uint64)
    begin, end = offsets[row] + first, offsets[row] + last + length
    for lo, hi in blocks(offsets, _BLOCK_BYTES):
        a, b = np.searchsorted(row, [lo, hi])
        base = offsets[lo]
        out[a:b] = span_hashes(raw[base : offsets[hi]], begin[a:b] - base, end[a:b] - base)
    return out


def _shard_marker(length: int):
    def run(table: pa.Table) -> pa.Table:
        give_back(others=True)
        groups: list[int] = []
        parts: list[list[np.ndarray]] = []
        rows: list[tuple] = []
        for r in table.to_pylist():
            if r["settled"]:
                rows.append((r["grp"], r["payload"], r["size"]))
            else:
                kinds = [np.int64, np.int32, np.int32, np.int32]
                parts.append(_unpacked(r["payload"], r["size"], kinds))
                groups.append(r["grp"])
        if parts:
            owner = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
            ids, row, first, last, text = (np.concatenate(x) for x in zip(*parts))
            size = last.astype(np.int64) - first + length
            begin = np.cumsum(size) - size
            starts = size - length + 1
            wanted = np.arange(int(starts.sum())) - np.repeat(np.cumsum(starts) - starts, starts)
            wanted += np.repeat(begin, starts)
            order = sort_suffixes(text, begin + size, wanted, length)
            shared = common_prefixes(text, order, length) >= length
            run_of = np.searchsorted(begin, order, "right") - 1
            group = np.cumsum(~shared) - 1
            least = np.minimum.reduceat(ids[run_of], np.flatnonzero(~shared))
            gone = np.zeros(len(text) + 1, bool)
            gone[order[ids[run_of] > least[group]]] = True
            # Neighbouring marked starts of one run make one mark.
            starts_at = np.zeros(len(text) + 1, bool)
            starts_at[begin] = True
            opens = np.flatnonzero(gone[:-1] & (starts_at[:-1] | ~np.append(False, gone[:-2])))
            closes = np.flatnonzero(gone[:-1] & (starts_at[1:] | ~gone[1:]))
            which = np.searchsorted(begin, opens, "right") - 1
            lo = first[which] + opens - begin[which]
            hi = first[which] + closes - begin[which] + length
            # The marks come in the order of the parts.
            of = owner[which]
            edges = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(of)).tolist()
            found = [x.astype(np.int32) for x in (row[which], lo, hi)]
            for a, b in zip(edges, edges[1:]):
                rows.append((groups[of[a]], *_packed([x[a:b] for x in found])))
        return _table(rows, [pa.int32(), pa.binary(), pa.int64()], _MARKS)

    return run


def _cutter(outputs: tuple[str, ...]):
    def run(table: pa.Table, marks: pa.Table) -> pa.Table:
        give_back(others=True)
        if table.num_rows:
            table = _sorted_rows(table)
        return _cut(table, zip(*(marks.column(c).to_pylist() for c in ("payload", "size"))), outputs)

    return run


def _keeper(outputs: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back(others=True)
        for batch in batches:
            yield from _cut(pa.Table.from_batches([batch]), (), outputs).to_batches()

    return run


def _cut(table: pa.Table, marks: Iterable[tuple[bytes, int]], outputs: tuple[str, ...]) -> pa.Table:
    raw, offsets = text_bytes(table.column("text"))
    gone = np.zeros(len(raw) + 1, np.int32)
    for payload, size in marks:
        row, lo, hi, _ = _unpacked(payload, size, [np.int32] * 3)
        np.add.at(gone, offsets[row] + lo, 1)
        np.add.at(gone, offsets[row] + hi, -1)
    flags = np.cumsum(gone[:-1]) > 0
    before = np.append(False, flags[:-1])
    before[offsets[:-1][offsets[:-1] < len(raw)]] = False
    opens = np.flatnonzero(flags & ~before)
    closes = np.flatnonzero(flags & ~np.append(flags[1:], False)) + 1
    ends = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(raw))]
    closes = np.union1d(closes, ends[flags[ends - 1]])
    runs = np.searchsorted(opens, offsets)
    kept = raw[~flags].tobytes()
    kept_at = np.concatenate([[0], np.cumsum(~flags)])[offsets]
    pieces = [kept[a:b] for a, b in zip(kept_at.tolist(), kept_at[1:].tolist())]
    rows = row_of(runs)
    n = np.diff(offsets)
    edges = pa.array(runs, pa.int32())
    columns = {
        "row": table.column("row"),
        "n_bytes": pa.array(n, pa.int64()),
        "n_removed": pa.array(n - np.diff(kept_at), pa.int64()),
        "n_spans": pa.array(np.diff(runs), pa.int64()),
        "kept_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in pieces], pa.string()),
        "kept": pa.array(pieces, pa.binary()),
        "kept_text": pa.array([p.decode(errors="ignore") for p in pieces], pa.string()),
        "span_starts": pa.ListArray.from_arrays(edges, pa.array(opens - offsets[rows], pa.int32())),
        "span_ends": pa.ListArray.from_arrays(edges, pa.array(closes - offsets[rows], pa.int32())),
    }
    names = ["row", *outputs]
    return pa.Table.from_arrays([columns[c] for c in names], names=names)


def repeats_removed(
    docs: DataFrame,
    length: int = 50,
    group_bytes: int = 1 << 23,
    key: str = "doc_id",
    text: str = "text",
    carry: list[str] | None = None,
    outputs: tuple[str, ...] = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"),
    most_runs: int = 1 << 15,
    shard_bytes: int = 1 << 21,
) -> DataFrame:
    """``row``, a struct of the carried columns (the key alone unless said otherwise),
    and the outputs asked for: ``n_bytes, n_removed, n_spans, kept_sha256``, the
    remaining bytes ``kept`` and their text ``kept_text`` (less the bytes of characters that
    a cut runs through), and the removed spans ``span_starts, span_ends`` in bytes.

    The id must be of an integer type; ``length`` is at least 16.
    """
    if length < _PART:
        raise ValueError(f"length must be at least {_PART}")
    spark = docs.sparkSession
    total = docs.select(F.sum(F.octet_length(column(docs, text)))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(parts, -(-total // group_bytes))
    shards = max(parts, -(-total // min(group_bytes, shard_bytes)))
    parts = max(parts, shards // 8)
    source = docs.select(
        column(docs, key, "key").cast("bigint").alias("key"),
        F.coalesce(column(docs, text), F.lit("")).alias("text"),
        F.struct(*[column(docs, c) for c in (carry or [key])]).alias("row"),
    )
    group = F.pmod(F.xxhash64("key", "text"), F.lit(groups)).cast("int").alias("grp")
    grouped = source.where(F.col("key").isNotNull()).select(group, "*").repartition(parts, "grp")

    keys = grouped.groupBy("grp").applyInArrow(_key_sender(length, shards), _KEYS)
    answers = keys.groupBy("shard").applyInArrow(_answer(most_runs), _ANSWERS)
    sent = (
        grouped.groupBy("grp")
        .cogroup(answers.groupBy("grp"))
        .applyInArrow(_run_sender(length, shards), _SENT)
    )
    marks = sent.groupBy("shard").applyInArrow(_shard_marker(length), _MARKS)
    kinds = {"kept": "binary", "kept_sha256": "string", "kept_text": "string"}
    kinds |= dict.fromkeys(("n_bytes", "n_removed", "n_spans"), "bigint")
    kinds |= dict.fromkeys(("span_starts", "span_ends"), "array<int>")
    fields = ", ".join(f"{c} {kinds[c]}" for c in outputs)
    schema = schema_after(source.schema["row"], fields)
    cut = grouped.groupBy("grp").cogroup(marks.groupBy("grp"))
    loose = source.where(F.col("key").isNull()).select("row", "text")
    return cut.applyInArrow(_cutter(outputs), schema).union(
        loose.mapInArrow(_keeper(outputs), schema)
    )


def without_repeats(
    docs: DataFrame, length: int = 50, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with the repeated bytes cut from the texts; a document of which nothing
    but white space is left goes, if it lost something. Bytes of a character that a cut
    runs through go too."""
    void = "void"
    while void in docs.columns:
        void += "_"
    others = [c for c in docs.columns if c != text]
    cut = repeats_removed(
        docs.withColumn(void, column(docs, text).isNull()),
        length,
        key=key,
        text=text,
        carry=[*others, void],
        outputs=("n_removed", "kept_text"),
    )
    left = F.when(~F.col("row")[void], F.col("kept_text"))
    gone = (F.col("n_removed") > 0) & (F.trim("kept_text") == "")
    return cut.where(~gone).select(
        *[left.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns]
    )

"""Documents packed into training sequences of equal token capacity and even cost.

The cost of a piece of n tokens is estimated as ``linear * n + quadratic * n * n``:
layers that work token by token, and attention within the piece. Pieces of a full
capacity fill a sequence each. The rest of every document is assigned in descending
order of cost to the sequence of lowest cost that has room for it. If none has room, it
is cut: the sequence with most room takes what fits, and what is left goes on as a piece
of its own. A group of documents gets exactly the sequences its tokens need, so at most
one capacity is padded per group.

A task packs the documents it reads, a bounded number of tokens at a time, while it has
their ids at hand: nothing is shuffled, and a task that runs again gives whole
sequences again, as none is shared between tasks.

Defined results: a null or empty text is one piece that holds the end token; a null id
stays null; repeated rows are packed once each; an empty table gives no rows; columns
other than the two named are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import encoder
from .columns import column, give_back, text_bytes

_SEQUENCE_BITS = 33


def pack_group(
    lengths: np.ndarray, capacity: int, linear: float = 1.0, quadratic: float = 1 / 1024
) -> np.ndarray:
    """Rows ``document, start, length, sequence, offset`` for documents of these lengths."""

    def cost(n: int) -> float:
        return linear * n + quadratic * n * n

    lengths = np.asarray(lengths, np.int64)
    full, rest = np.divmod(lengths, capacity)
    documents = np.repeat(np.arange(len(lengths)), full)
    within = np.arange(len(documents)) - np.repeat(np.cumsum(full) - full, full)
    n_full = len(documents)
    rows = [
        np.stack(
            [
                documents,
                within * capacity,
                np.full(n_full, capacity),
                np.arange(n_full),
                np.zeros(n_full, np.int64),
            ],
            axis=1,
        )
    ]
    left = int(rest.sum())
    bins = -(-left // capacity)
    used = [0] * bins
    by_cost = [(0.0, i) for i in range(bins)]
    out = []
    order = np.lexsort((np.arange(len(rest)), -rest))
    for d in order[: int(np.count_nonzero(rest))].tolist():
        start, n = int(full[d]) * capacity, int(rest[d])
        while n:
            passed = []
            while by_cost and used[by_cost[0][1]] + n > capacity:
                passed.append(heapq.heappop(by_cost))
            if by_cost:
                spent, i = heapq.heappop(by_cost)
                take = n
            else:
                spent, i = min(passed, key=lambda x: (used[x[1]], x))
                passed.remove((spent, i))
                take = capacity - used[i]
            out.append((d, start, take, n_full + i, used[i]))
            used[i] += take
            if used[i] < capacity:
                heapq.heappush(by_cost, (spent + cost(take), i))
            for x in passed:
                heapq.heappush(by_cost, x)
            start, n = start + take, n - take
    rows.append(np.array(out, np.int64).reshape(-1, 5))
    return np.concatenate(rows)


def packed(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int | None = 1,
    linear: float = 1.0,
    quadratic: float = 1 / 1024,
    group_tokens: int = 1 << 21,
    with_ids: bool = False,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: ``key, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, cost`` and, on request, ``ids``.

    ``ids_crc32`` is over the piece's ids as little-endian 32-bit words. ``group_tokens``
    bounds what a task holds at a time; a longer document is a group of its own.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    source = docs.select(column(docs, key, "key"), column(docs, text, "text"))
    fields = (
        "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, cost double"
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        base = TaskContext.get().partitionId() << _SEQUENCE_BITS
        kept: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal kept, held, base
            if kept:
                rows, used = _rows(kept)
                base += used
                yield rows
            kept, held = [], 0

        def _rows(groups) -> tuple[pa.RecordBatch, int]:
            keys = pa.concat_arrays([k for k, _, _ in groups])
            ids = np.concatenate([i for _, i, _ in groups])
            lengths = np.concatenate([n for _, _, n in groups])
            first = np.cumsum(lengths) - lengths
            rows = pack_group(lengths, capacity, linear, quadratic)
            d, start, n, sequence, offset = rows.T
            begin = first[d] + start
            view = memoryview(ids.astype("<u4", copy=False)).cast("B")
            spans = zip((4 * begin).tolist(), (4 * (begin + n)).tolist())
            crc = np.array([zlib.crc32(view[a:b]) for a, b in spans], np.int64)
            columns = [keys.take(pa.array(d)), start, n, crc, lengths[d], base + sequence, offset]
            columns.append(linear * n + quadratic * n.astype(np.float64) ** 2)
            names = [f.split()[0] for f in fields.split(", ")]
            if with_ids:
                place = np.arange(int(n.sum())) + np.repeat(begin - (np.cumsum(n) - n), n)
                edges = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
                columns.append(pa.ListArray.from_arrays(edges, pa.array(ids[place].astype(np.int32))))
                names.append("ids")
            columns = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
            used = int(sequence.max()) + 1 if len(sequence) else 0
            return pa.RecordBatch.from_arrays(columns, names=["key", *names]), used

        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            lo = 0
            while lo < batch.num_rows:
                # Texts have fewer ids than bytes.
                room = max(1, group_tokens - held)
                hi = int(np.searchsorted(offsets, offsets[lo] + room, "right")) - 1
                hi = min(max(hi, lo + 1), batch.num_rows)
                at = offsets[lo : hi + 1] - offsets[lo]
                ids, edges = own.encode(raw[offsets[lo] : offsets[hi]], at)
                n = np.diff(edges)
                if end_id is not None:
                    ids = np.insert(ids, edges[1:], np.uint32(end_id))
                    n = n + 1
                kept.append((batch.column("key").slice(lo, hi - lo), ids, n))
                held += len(ids)
                lo = hi
                if held >= group_tokens // 2:
                    yield from flush()
        yield from flush()
        give_back()

    kind = source.schema["key"].dataType.simpleString()
    schema = f"key {kind}, {fields}" + (", ids array<int>" if with_ids else "")
    return source.mapInArrow(pack, schema).withColumnRenamed("key", key)

"""Arrow string columns as flat byte arrays, and what the text operators share.

Operators of this package read texts in ``mapInArrow`` tasks. A batch's strings lie in
one buffer; working on that buffer with numpy spares a Python object per text or word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Odd multipliers with well mixed bits (the fractional bits of square roots of primes).
_MIX_1 = np.uint64(0xBB67AE8584CAA73B)
_MIX_2 = np.uint64(0x3C6EF372FE94F82B)
_BASE = np.uint64(0xA54FF53A5F1D36F1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= _MIX_1
    x ^= x >> np.uint64(29)
    x *= _MIX_2
    x ^= x >> np.uint64(32)
    return x


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows and the n + 1 offsets of the rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_large_string(column.type) or pa.types.is_string(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    return raw, at - at[0]


def blocks(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes each; a longer row makes its own range."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


# A Mersenne prime, a base with well mixed bits below it, and the parts of a number.
_PRIME = np.uint64((1 << 61) - 1)
_LOW, _SHIFT = np.uint64((1 << 31) - 1), np.uint64(31)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for any 64-bit x."""
    x = (x & _PRIME) + (x >> np.uint64(61))
    return np.where(x >= _PRIME, x - _PRIME, x)


def _shifted(x: np.ndarray) -> np.ndarray:
    """2^31 x modulo the prime: its 61 bits turned by 31."""
    return ((x << _SHIFT) & _PRIME) | (x >> np.uint64(30))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a b modulo the prime, in parts of 31 and 30 bits."""
    a0, a1, b0, b1 = a & _LOW, a >> _SHIFT, b & _LOW, b >> _SHIFT
    middle = a1 * b0 + a0 * b1
    # 2^62 is 2 and 2^61 is 1.
    high = np.uint64(2) * a1 * b1 + (middle >> np.uint64(30))
    return _reduced(high + ((middle << _SHIFT) & _PRIME) + _reduced(a0 * b0))


def _base_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo the prime, at least n of them."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        base, size = int(_BASE) % int(_PRIME), 1 << max(16, int(n - 1).bit_length())

        def table(base: int) -> np.ndarray:
            out = np.ones(1, np.uint64)
            while len(out) < size:
                step = np.uint64(pow(base, len(out), int(_PRIME)))
                out = np.concatenate([out, _product(out, step)])
            return out

        have = _powers[0] = table(base), table(pow(base, -1, int(_PRIME)))
    return have


def span_sums(values: np.ndarray) -> np.ndarray:
    """What hashes of any spans of bytes or code points are taken from: prefix sums of the
    two halves of every term."""
    n = len(values)
    power, v = _base_powers(n + 1)[0][:n], values.astype(np.uint64) + np.uint64(1)
    # Values are below 2^21, so the product of a power is one number of 62 bits.
    high = v * (power >> _SHIFT)
    terms = ((high & np.uint64((1 << 30) - 1)) << _SHIFT) + (high >> np.uint64(30))
    terms += v * (power & _LOW)
    sums = np.zeros((2, n + 1), np.uint64)
    np.cumsum(terms & _LOW, out=sums[0, 1:])
    np.cumsum(terms >> _SHIFT, out=sums[1, 1:])
    return sums


def span_hashes(
    values: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None
) -> np.ndarray:
    """64-bit hashes of the spans ``values[start:end]`` of bytes or code points, equal for
    equal spans.

    A polynomial modulo the prime 2^61 - 1, from prefix sums: every span costs the same
    whatever its length. Two spans of n values that differ agree for at most n bases.
    """
    sums = span_sums(values) if sums is None else sums
    low, high = (_reduced(x[ends] - x[starts]) for x in sums)
    out = _product(_reduced(low + _shifted(high)), _base_powers(sums.shape[1])[1][starts])
    return mixed(out + (ends - starts).astype(np.uint64) * _BASE)


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte as it is."""
    return _LOWER[raw]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_spans(
    raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes, and the n + 1 word offsets.

    ``is_word`` holds 256 booleans. Runs never cross rows.
    """
    inside = is_word[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(raw))]
    begins[cut] |= inside[cut]
    finishes[cut - 1] |= inside[cut - 1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finishes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def row_of(offsets: np.ndarray) -> np.ndarray:
    """The row of every item, from the n + 1 offsets of the items."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


_kept: list[Callable[[], None]] = []


def kept_by_worker(make: Callable) -> Callable:
    """``make`` with its results kept for the next task of the worker process, until a task
    of another operator asks for the room."""
    made = cache(make)
    _kept.append(made.cache_clear)
    return made


def give_back(others: bool = False) -> None:
    """Return freed memory to the system: a worker process outlives its task, and what
    numpy and Arrow keep for their next array is missing to the tasks beside it. With
    ``others``, what other operators keep in this process goes as well."""
    if others:
        for clear in _kept:
            clear()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def give_back_driver(spark: SparkSession) -> None:
    """Return freed memory of the driver's two processes to the system. Every thread that
    plans, compiles or sends leaves its own in the JVM's native heap, beside the Java heap
    and out of its limit: after a hundred jobs more than the plans themselves take. A JVM
    without the command keeps it."""
    give_back()
    jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
    name = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    values = array(jvm.java.lang.Object, 4)
    values[0], values[1] = name, "systemTrimNativeHeap"
    # By the interface's method: the class of the server is none that others may call.
    methods = jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods()
    (invoke,) = [m for m in methods if m.getName() == "invoke"]
    try:
        invoke.invoke(server, values)
    except Py4JJavaError:
        pass


def schema_after(first: StructField, fields: str) -> StructType:
    """A schema of one column as it is, nullability within it included, and new ones."""
    return StructType([first, *StructType.fromDDL(fields).fields])


def column(df: DataFrame, name: str, alias: str | None = None) -> Column:
    """A column by its exact name, also where the name holds dots."""
    return F.col("`" + name.replace("`", "``") + "`").alias(alias or name)

"""Upper bounds of path support before the shuffle of all path records.

A path cannot link more pairs than it has records. A count-min sketch adds the records of
every path into one slot of each of ``rows`` tables of ``slots`` counters, so the least of
a path's counters is never below its number of records. Paths with a counter below
``dpmin`` can't be frequent, and their records stay out of the count per (path, a, b), the
one shuffle of corpus size. With word formats nearly all paths are of this kind.

Sketches of parts of a corpus add up, slot by slot. Each task sends at most one row per
counter, whatever it reads. What comes back to the tasks are bits, ``rows * slots`` of
them: the size is a parameter and does not grow with the data. More paths than slots let
more of them through, and never lose one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD = 64


def _slot(dp: Column, row: int, slots: int) -> Column:
    return F.pmod(F.xxhash64(dp, F.lit(row)), F.lit(slots))


def support_sketch(records: DataFrame, slots: int = 1 << 20, rows: int = 4) -> DataFrame:
    """``slot, n``: the counters that are not zero, those of table r from r * ``slots`` on."""
    places = [_slot(F.col("dp"), r, slots) + F.lit(r * slots) for r in range(rows)]
    counted = records.select(F.explode(F.array(*places)).alias("slot"))
    return counted.groupBy("slot").agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(first: DataFrame, second: DataFrame) -> DataFrame:
    """The sketch of both corpora together."""
    return first.unionByName(second).groupBy("slot").agg(F.sum("n").alias("n"))


def heavy_bits(sketch: DataFrame, dpmin: int, slots: int = 1 << 20, rows: int = 4) -> DataFrame:
    """One row, ``bits``: an array of 64-bit words with a bit for every counter of at least
    ``dpmin``."""
    if slots % _WORD:
        raise ValueError(f"slots must be a multiple of {_WORD}")
    heavy = sketch.where(F.col("n") >= dpmin).select(
        F.shiftright("slot", 6).alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("slot") % _WORD).cast("int")).alias("bit"),
    )
    words = heavy.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    every = sketch.sparkSession.range(rows * slots // _WORD).withColumnRenamed("id", "word")
    filled = every.join(words, "word", "left").select("word", F.coalesce("bits", F.lit(0)).alias("bits"))
    # As many entries as the parameters say.
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return filled.agg(F.transform(ordered, lambda w: w["bits"]).alias("bits"))


def possibly_frequent(
    records: DataFrame, bits: DataFrame, slots: int = 1 << 20, rows: int = 4
) -> DataFrame:
    """The records whose path may reach the ``dpmin`` the bits were made for."""
    known = records.withColumn("_bits", bits.scalar())
    keep = F.lit(True)
    for r in range(rows):
        slot = _slot(F.col("dp"), r, slots) + F.lit(r * slots)
        word = F.get("_bits", F.shiftright(slot, 6).cast("int"))
        keep &= F.call_function("getbit", word, (slot % _WORD).cast("int")) == 1
    return known.where(keep).drop("_bits")

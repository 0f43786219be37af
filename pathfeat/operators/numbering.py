"""Dense numbers and running totals over the whole of a distributed table.

A window without partitioning would pass every row through one task. Here the rows
are range-partitioned and sorted, each partition works for itself, and one small
row per partition carries the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.staging import stage

# monotonically_increasing_id: partition number above, row number in the lower 33 bits.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def _sorted_rows(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """Rows in global order with their partition and place in it.

    The table is staged, so both stay fixed however often it is read.
    """
    placed = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    return (
        stage(placed, "sorted")
        .withColumn("_part", F.shiftright("_place", _ROW_BITS))
        .withColumn("_row", F.col("_place").bitwiseAND(F.lit(_ROW_MASK)))
        .drop("_place")
    )


def _with_offsets(rows: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Join to each row the totals of all partitions before its own.

    The broadcast side has one row per sort partition, whatever the data.
    """
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sums = rows.groupBy("_part").agg(*[c.alias(name) for name, c in totals.items()])
    offsets = sums.select(
        "_part", *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name) for name in totals]
    )
    return rows.join(F.broadcast(offsets), "_part")


def dense_ids(df: DataFrame, order: list[str], name: str = "id", start: int = 0) -> DataFrame:
    """Number the rows ``start, start + 1, ...`` in the order of the given columns."""
    rows = _sorted_rows(df, order)
    numbered = _with_offsets(rows, {"_offset": F.count(F.lit(1))})
    number = (F.col("_offset") + F.col("_row") + start).cast("bigint")
    return numbered.select(*df.columns, number.alias(name))


def running_totals(df: DataFrame, order: list[str | Column], totals: dict[str, str]) -> DataFrame:
    """Add running sums, ``totals`` mapping new names to summed columns."""
    rows = _sorted_rows(df, order)
    within = W.partitionBy("_part").orderBy("_row").rowsBetween(W.unboundedPreceding, 0)
    offsets = {f"_before_{new}": F.sum(old) for new, old in totals.items()}
    summed = _with_offsets(rows, offsets).select(
        "*", *[F.sum(old).over(within).alias(f"_within_{new}") for new, old in totals.items()]
    )
    return summed.select(
        *df.columns,
        *[(F.col(f"_before_{new}") + F.col(f"_within_{new}")).alias(new) for new in totals],
    )

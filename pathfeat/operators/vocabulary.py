"""Path support, the path vocabulary and its dense numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .numbering import dense_ids


def path_cells(records: DataFrame) -> DataFrame:
    """Path records counted per ``dp, a, b``.

    The one shuffle of the whole corpus. Everything later works on these counts.
    Keys are the whole triple, so a path that holds a third of all records is spread
    over the tasks, and the partial aggregate folds repeats before the shuffle.
    """
    return records.groupBy("dp", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def merge_cells(cells: DataFrame) -> DataFrame:
    """Cells of several corpora, added up."""
    return cells.groupBy("dp", "a", "b").agg(F.sum("n").alias("n"))


def path_support(cells: DataFrame) -> DataFrame:
    """Distinct ordered pairs and records of every path.

    Cells are distinct, so a count of rows is the count of distinct pairs, with
    partial sums per task and one row per path and task in the shuffle.
    """
    return cells.groupBy("dp").agg(
        F.count(F.lit(1)).alias("n_pairs"), F.sum("n").alias("n_records")
    )


def frequent_paths(support: DataFrame, dpmin: int) -> DataFrame:
    """Paths that link at least ``dpmin`` distinct pairs."""
    return support.where(F.col("n_pairs") >= dpmin)


def number_paths(paths: DataFrame) -> DataFrame:
    """``dp, id`` with ids 0, 1, ... in binary order of the path."""
    return dense_ids(paths.select("dp"), ["dp"])


def vector_size(vocabulary: DataFrame) -> DataFrame:
    """One row: the number of numbered paths."""
    return vocabulary.agg(F.coalesce(F.max("id") + 1, F.lit(0)).alias("vec_size"))


def max_by_key(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Largest value per key, at least 0."""
    return rows.groupBy(key).agg(
        F.greatest(F.max(value), F.lit(0)).cast("bigint").alias(value)
    )


def kept_records(records: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Path records whose path is in the vocabulary."""
    return records.join(vocabulary.select("dp"), "dp", "left_semi")

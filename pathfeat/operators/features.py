"""From counted paths and labelled pairs to feature vectors.

Joins carry no broadcast hints. The vocabulary and the labels are staged tables of
known size, so the planner broadcasts them below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond it, where adaptive
execution splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import lpad_index
from ..options import Options


def both_orders(rows: DataFrame) -> DataFrame:
    """Every row for (a, b) again for (b, a)."""
    rest = [c for c in rows.columns if c not in ("a", "b")]
    pairs = F.array(
        F.struct(F.col("a").alias("a"), F.col("b").alias("b")),
        F.struct(F.col("b").alias("a"), F.col("a").alias("b")),
    )
    return rows.select(*rest, F.inline(pairs))


def numbered_pairs(
    records: DataFrame, vocabulary: DataFrame, options: Options = Options()
) -> DataFrame:
    """Path records with the id of their path, in both pair orders when symmetric."""
    joined = records.join(vocabulary, "dp")
    return both_orders(joined) if options.symmetric else joined


def pair_labels(labels: DataFrame, options: Options = Options()) -> DataFrame:
    """One label per pair."""
    merged = labels.groupBy("a", "b").agg(
        F.bool_or("label").alias("label"), F.bool_and("label").alias("_all")
    )
    if options.label_rule == "drop_conflicts":
        merged = merged.where(F.col("label") == F.col("_all"))
    return merged.drop("_all")


def _lookups(labels: DataFrame, options: Options) -> DataFrame:
    """Labelled pairs with the pairs whose cells are their evidence.

    The labels are flipped instead of the cells: the corpus side is never doubled.
    """
    own = F.struct(F.col("a").alias("_x"), F.col("b").alias("_y"))
    flipped = F.struct(F.col("b").alias("_x"), F.col("a").alias("_y"))
    sides = F.array_distinct(F.array(own, flipped)) if options.symmetric else F.array(own)
    return labels.select("a", "b", "label", F.inline(sides))


def labelled_cells(
    cells: DataFrame, vocabulary: DataFrame, labels: DataFrame, options: Options = Options()
) -> DataFrame:
    """``a, b, label, id, n`` for labelled pairs with evidence.

    The vocabulary comes first: cells of infrequent paths, with some formats most of
    them, are gone before the join with the labels.
    """
    kept = cells.join(vocabulary, "dp")
    evidence = kept.select(F.col("a").alias("_x"), F.col("b").alias("_y"), "id", "n")
    return (
        _lookups(labels, options)
        .join(evidence, ["_x", "_y"])
        .groupBy("a", "b", "label", "id")
        .agg(F.sum("n").alias("n"))
    )


def label_join(found: DataFrame, labels: DataFrame) -> DataFrame:
    """All labelled pairs with their cells; pairs without evidence keep null cells."""
    return labels.join(found.drop("label"), ["a", "b"], "left")


def labels_without_evidence(found: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled pairs with no path of the vocabulary."""
    return labels.join(found.select("a", "b"), ["a", "b"], "left_anti")


def sparse_vectors(found: DataFrame) -> DataFrame:
    """``a, b, label, cells``: the counted ids of a pair in id order.

    A group holds at most one entry per path of the vocabulary. Pairs without any
    entry have no row, which is the all-zero filter.
    """
    return found.groupBy("a", "b", "label").agg(
        F.array_sort(F.collect_list(F.struct("id", "n"))).alias("cells")
    )


def dense_array(cells: Column, size: Column) -> Column:
    """Counts 0..size-1 with the gaps between sparse cells filled by zeros."""
    zero = F.lit(0).cast("bigint")

    def with_gap(cell: Column, at: Column) -> Column:
        previous = F.coalesce(F.get(cells, at - 1)["id"], F.lit(-1))
        gap = (cell["id"] - previous - 1).cast("int")
        return F.concat(F.array_repeat(zero, gap), F.array(cell["n"]))

    last = F.coalesce(F.get(cells, F.size(cells) - 1)["id"], F.lit(-1))
    return F.concat(
        F.flatten(F.transform(cells, with_gap)),
        F.array_repeat(zero, (size - last - 1).cast("int")),
    )


def dense_vectors(sparse: DataFrame, size: DataFrame) -> DataFrame:
    """``a, b, label, features`` with one count per path of the vocabulary."""
    sized = sparse.withColumn("_size", size.scalar())
    return sized.select(
        "a", "b", "label", dense_array(F.col("cells"), F.col("_size")).alias("features")
    )


def dense_cells(found: DataFrame, labels: DataFrame, size: DataFrame) -> DataFrame:
    """``a, b, idx, n`` for every labelled pair and every id, zeros included.

    The index is padded to the digits of the vector size, as the text form needs.
    """
    every = labels.join(sparse_vectors(found).drop("label"), ["a", "b"], "left").select(
        "a",
        "b",
        F.coalesce("cells", F.array().cast("array<struct<id:bigint,n:bigint>>")).alias("cells"),
    )
    sized = every.withColumn("_size", size.scalar())
    filled = dense_array(F.col("cells"), F.col("_size"))
    return sized.select("a", "b", "_size", F.posexplode(filled).alias("_id", "n")).select(
        "a", "b", lpad_index(F.col("_id"), F.col("_size")).alias("idx"), "n"
    )


def vector_text(features: Column, label: Column) -> Column:
    """``c0,c1,...,label`` with the label as True or False."""
    return F.concat_ws(
        ",", F.transform(features, lambda n: n.cast("string")), _truth(label)
    )


def _truth(label: Column) -> Column:
    return F.when(label, "True").otherwise("False")

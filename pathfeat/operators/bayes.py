"""Multinomial naive Bayes, cross-validated by leaving folds out of one set of counts.

The model is made of counts that add up: rows per class, and occurrences per class and
path. One aggregate counts them per fold; the model without a fold is the total less the
fold's own counts, so no model is fitted and the rows are read once for all folds. A
second join and sum score every row with the model that did not see it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.staging import stage


def _sums(value: Column, folds: list[int], label: bool) -> Column:
    """An array of one sum per fold, of rows of one label."""
    own = F.col("label") if label else ~F.col("label")
    return F.array(
        *[F.coalesce(F.sum(F.when(own & (F.col("fold") == f), value)), F.lit(0)) for f in folds]
    )


def path_counts(vectors: DataFrame, folds: list[int]) -> DataFrame:
    """``id, true, false``: occurrences of a path in the rows of either label, one number
    per fold. Partial sums go before the shuffle, so a common path is a row per task."""
    cells = vectors.select("label", "fold", F.inline("cells"))
    return cells.groupBy("id").agg(
        _sums(F.col("n"), folds, True).alias("true"), _sums(F.col("n"), folds, False).alias("false")
    )


def _without(counts: Column) -> Column:
    """Per fold, the total less the fold's own."""
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda x, y: x + y)
    return F.transform(counts, lambda own: (total - own).cast("double"))


def log_odds(counts: DataFrame, smoothing: float) -> DataFrame:
    """``id, odds``: the log of the ratio of a path's smoothed counts, per fold left out."""
    odds = F.zip_with(
        _without(F.col("true")), _without(F.col("false")),
        lambda t, f: F.log(t + smoothing) - F.log(f + smoothing),
    )
    return counts.select("id", odds.alias("odds"))


def class_odds(
    vectors: DataFrame, counts: DataFrame, folds: list[int], size: int, smoothing: float
) -> DataFrame:
    """One row: per fold left out, ``base``, the log odds of the classes, and ``each``,
    what every occurrence of any path adds."""
    rows = vectors.agg(
        _sums(F.lit(1), folds, True).alias("true"), _sums(F.lit(1), folds, False).alias("false")
    )
    totals = counts.agg(
        *[
            F.array(*[F.coalesce(F.sum(F.get(c, F.lit(k))), F.lit(0)) for k in range(len(folds))]).alias(c)
            for c in ("true", "false")
        ]
    )
    ratio = lambda t, f, by: F.zip_with(
        _without(t), _without(f), lambda x, y: F.log(x + by) - F.log(y + by)
    )
    base = rows.select(ratio(F.col("true"), F.col("false"), smoothing).alias("base"))
    each = totals.select(
        F.transform(ratio(F.col("true"), F.col("false"), smoothing * size), lambda x: -x).alias("each")
    )
    return base.select("base", each.scalar().alias("each"))


def naive_bayes(
    vectors: DataFrame, folds: list[int], size: int, smoothing: float = 1.0
) -> DataFrame:
    """``a, b, label, fold, score, prediction`` for the vectors ``a, b, label, fold, cells``,
    each by the model of the other folds; ``size`` is the number of paths."""
    counts = stage(path_counts(vectors, folds), "bayes-counts")
    odds = stage(log_odds(counts, smoothing), "bayes-odds")
    classes = class_odds(vectors, counts, folds, size, smoothing)
    place = F.array_position(F.lit(folds), F.col("fold")).cast("int") - 1
    cells = vectors.select("a", "b", "label", "fold", place.alias("_k"), F.inline("cells"))
    added = F.col("n") * (F.get("odds", F.col("_k")) + F.get("_each", F.col("_k")))
    rows = (
        cells.join(odds, "id")
        .withColumn("_each", classes.select("each").scalar())
        .groupBy("a", "b", "label", "fold", "_k")
        .agg(F.sum(added).alias("_x"))
    )
    total = F.col("_x") + F.get(classes.select("base").scalar(), F.col("_k"))
    return rows.select("a", "b", "label", "fold", total.alias("_x")).select(
        "a", "b", "label", "fold",
        (1 / (1 + F.exp(-F.col("_x")))).alias("score"), (F.col("_x") > 0).alias("prediction"),
    )

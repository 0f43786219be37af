"""Evaluation of predictions ``a, b, label, score, prior, prediction`` by aggregates.

``score`` is the predicted probability of true and ``prior`` that of a predictor
that knows the class shares only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .numbering import running_totals

BUCKETS = ("tp", "fp", "fn", "tn")


def bucket() -> Column:
    """Confusion bucket of a row."""
    label, predicted = F.col("label"), F.col("prediction")
    return (
        F.when(predicted & label, "tp")
        .when(predicted & ~label, "fp")
        .when(~predicted & label, "fn")
        .otherwise("tn")
    )


def confusion_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, part.cast("double") / whole)


def _confusion_row(predictions: DataFrame) -> DataFrame:
    kind = bucket()
    return predictions.agg(*[F.count_if(kind == b).alias(b) for b in BUCKETS])


def summary(predictions: DataFrame) -> DataFrame:
    """One row: counts, accuracy, kappa and the probability errors.

    Relative errors compare with the errors of the prior, in percent.
    """
    actual = F.col("label").cast("double")
    off, base = F.col("score") - actual, F.col("prior") - actual
    kind = bucket()
    sums = predictions.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(kind == b).alias(b) for b in BUCKETS],
        F.avg(F.abs(off)).alias("mae"),
        F.sqrt(F.avg(off * off)).alias("rmse"),
        F.avg(F.abs(base)).alias("_mae0"),
        F.sqrt(F.avg(base * base)).alias("_rmse0"),
    )
    n, tp, fp, fn, tn = (F.col(c).cast("double") for c in ("n", "tp", "fp", "fn", "tn"))
    observed = (tp + tn) / n
    chance = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n)
    return sums.select(
        "n",
        (F.col("tp") + F.col("tn")).alias("correct"),
        (F.col("fp") + F.col("fn")).alias("incorrect"),
        _ratio(tp + tn, n).alias("accuracy"),
        F.when(n > 0, _ratio(observed - chance, 1 - chance)).alias("kappa"),
        "mae",
        "rmse",
        (100 * _ratio(F.col("mae"), F.col("_mae0"))).alias("relative_absolute_error"),
        (100 * _ratio(F.col("rmse"), F.col("_rmse0"))).alias("root_relative_squared_error"),
    )


def ranking_areas(predictions: DataFrame) -> DataFrame:
    """ROC and precision-recall areas per class, exact with ties.

    ROC is the share of (true, false) pairs in score order, ties counting half. The
    precision-recall area sums precision times the recall step at each score.
    Running counts are distributed, so any number of distinct scores will do.
    """
    by_score = predictions.groupBy("score").agg(
        F.count_if("label").alias("pos"), F.count_if(~F.col("label")).alias("neg")
    )
    # Totals from the top score down; what is below follows from the grand totals.
    ranked = running_totals(by_score, [F.desc("score")], {"pos_down": "pos", "neg_down": "neg"})
    totals = ranked.agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    all_pos = totals.select("_pos").scalar()
    all_neg = totals.select("_neg").scalar()
    # Doubles: products of counts outgrow 64-bit integers.
    counts = ("pos", "neg", "pos_down", "neg_down")
    rows = ranked.withColumns({c: F.col(c).cast("double") for c in counts})
    rows = rows.withColumn("_all_pos", all_pos.cast("double"))
    rows = rows.withColumn("_all_neg", all_neg.cast("double"))
    below_neg = F.col("_all_neg") - F.col("neg_down")
    up_pos = F.col("_all_pos") - F.col("pos_down") + F.col("pos")
    up_neg = below_neg + F.col("neg")
    won = F.sum(F.col("pos") * (2 * below_neg + F.col("neg")))
    sums = rows.agg(
        F.max("_all_pos").alias("p"),
        F.max("_all_neg").alias("q"),
        won.alias("won"),
        F.sum(_ratio(F.col("pos") * F.col("pos_down"), F.col("pos_down") + F.col("neg_down"))).alias(
            "pr_true"
        ),
        F.sum(_ratio(F.col("neg") * up_neg, up_pos + up_neg)).alias("pr_false"),
    )
    p, q = F.col("p"), F.col("q")
    roc = _ratio(F.col("won"), 2 * p * q).alias("roc_area")
    both = F.array(
        F.struct(F.lit(True).alias("class"), roc, _ratio(F.col("pr_true"), p).alias("prc_area")),
        F.struct(F.lit(False).alias("class"), roc, _ratio(F.col("pr_false"), q).alias("prc_area")),
    )
    return sums.select(F.inline(both))


def class_details(predictions: DataFrame) -> DataFrame:
    """One row per class: rates, precision, recall, F1, MCC and ranking areas."""
    counts = _confusion_row(predictions)

    def side(name: bool, tp: str, fp: str, fn: str, tn: str) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            F.col(tp).alias("_tp"),
            F.col(fp).alias("_fp"),
            F.col(fn).alias("_fn"),
            F.col(tn).alias("_tn"),
        )

    sides = counts.select(
        F.inline(F.array(side(True, "tp", "fp", "fn", "tn"), side(False, "tn", "fn", "fp", "tp")))
    )
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("_tp", "_fp", "_fn", "_tn"))
    rates = sides.select(
        "class",
        _ratio(tp, tp + fn).alias("tp_rate"),
        _ratio(fp, fp + tn).alias("fp_rate"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio(
            tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
        ).alias("mcc"),
    )
    # Two rows on either side.
    return rates.join(ranking_areas(predictions), "class")


def weighted_average(predictions: DataFrame) -> DataFrame:
    """One row: the class details averaged over the classes by their number of rows.

    A measure that a class doesn't have (no row of it, or none predicted) is left out.
    """
    sizes = predictions.groupBy(F.col("label").alias("class")).agg(F.count(F.lit(1)).alias("_n"))
    # Two rows on either side.
    rows = class_details(predictions).join(sizes, "class")
    weight = F.col("_n").cast("double")
    return rows.agg(
        *[
            _ratio(F.sum(weight * F.col(c)), F.sum(F.when(F.col(c).isNotNull(), weight))).alias(c)
            for c in rows.columns
            if c not in ("class", "_n")
        ]
    )


def confusion_samples(predictions: DataFrame, per_bucket: int = 5) -> DataFrame:
    """The first pairs of every confusion bucket in (a, b) order.

    The rank limit is applied per task before the shuffle (window group limit), so a
    bucket with most of the rows sends a handful of them.
    """
    rank = F.row_number().over(W.partitionBy("bucket").orderBy("a", "b"))
    return (
        predictions.withColumn("bucket", bucket())
        .withColumn("rank", rank)
        .where(F.col("rank") <= per_bucket)
        .select("bucket", "rank", "a", "b", "label", "prediction")
    )

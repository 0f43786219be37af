"""Cross-validated classifiers on sparse vectors.

Decision trees and naive Bayes come from aggregates over all folds at once; a tree on
binned counts, logistic regression and a linear support vector machine from Spark ML, one
fit per fold.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..plans.staging import stage
from .bayes import naive_bayes
from .linear import LinearModels, weights_table
from .numbering import dense_ids
from .tree import Trees, grow_trees

SPARSE = 0


@dataclass(frozen=True)
class ModelOptions:
    """Limits of the trained models; none of them drops rows.

    max_depth  levels of the trees, at most 30 with bins
    min_leaf   rows that either side of a split must have
    max_bins   candidate thresholds per path of the binned tree
    max_iter   iterations of the two linear models; a fit that needed them all
               raises a warning
    smoothing  added to every count by naive Bayes
    reg_param  regularisation of the linear support vector machine
    parallel   folds that Spark ML fits at the same time
    """

    max_depth: int = 10
    min_leaf: int = 2
    max_bins: int = 32
    max_iter: int = 100
    smoothing: float = 1.0
    reg_param: float = 1e-4
    parallel: int = 2


# Estimators of Spark ML, fitted once per fold.
ESTIMATORS: dict[str, Callable[[ModelOptions], Estimator]] = {
    "binned_tree": lambda o: DecisionTreeClassifier(
        impurity="entropy", maxDepth=o.max_depth, maxBins=o.max_bins, minInstancesPerNode=o.min_leaf, seed=1
    ),
    "logistic": lambda o: LogisticRegression(maxIter=o.max_iter),
    "linear_svc": lambda o: LinearSVC(maxIter=o.max_iter, regParam=o.reg_param),
}
CLASSIFIERS = ("decision_tree", "naive_bayes", *ESTIMATORS)


def _warn_unconverged(model: Model, classifier: str, fold: int, models: ModelOptions) -> None:
    if classifier == "logistic":
        used = model.summary.totalIterations
    elif classifier == "linear_svc":
        used = model.summary().totalIterations
    else:
        return
    if used >= models.max_iter:
        warnings.warn(f"{classifier}, fold {fold}: not converged after {used} iterations", stacklevel=2)


def assign_folds(vectors: DataFrame, folds: int = 10) -> DataFrame:
    """Add ``fold``: the rank within the label, in (a, b) order, modulo ``folds``.

    Each label is spread evenly over the folds. Ranks come from one dense numbering
    of the whole table; a window per label would put all its rows into one task.
    """
    ranked = dense_ids(vectors, ["label", "a", "b"], "_rank")
    first = ranked.groupBy("label").agg(F.min("_rank").alias("_first"))
    # Two labels make two rows.
    return (
        ranked.join(F.broadcast(first), "label")
        .withColumn("fold", ((F.col("_rank") - F.col("_first")) % folds).cast("int"))
        .select(*vectors.columns, "fold")
    )


def ml_vectors(sparse: DataFrame, size: int) -> DataFrame:
    """Staged table with ``features`` as a Spark ML sparse vector and ``target`` 0/1.

    The struct written to parquet is the storage form of the vector type, and the
    table is read back as that type: no Python, no dense array on the way.
    """
    rest = [c for c in sparse.columns if c != "cells"]
    packed = sparse.select(
        *rest,
        F.col("label").cast("double").alias("target"),
        F.struct(
            F.lit(SPARSE).cast("tinyint").alias("type"),
            F.lit(size).cast("int").alias("size"),
            F.transform("cells", lambda c: c["id"].cast("int")).alias("indices"),
            F.transform("cells", lambda c: c["n"].cast("double")).alias("values"),
        ).alias("features"),
    )
    schema = StructType(
        [
            StructField(f.name, VectorUDT() if f.name == "features" else f.dataType)
            for f in packed.schema.fields
        ]
    )
    return stage(packed, "ml_vectors", schema)


def cross_validate(
    sparse: DataFrame,
    size: int,
    classifier: str = "decision_tree",
    folds: int = 10,
    models: ModelOptions = ModelOptions(),
) -> DataFrame:
    """Predictions ``a, b, label, fold, score, prior, prediction`` for every vector.

    Each vector is predicted by the model trained on the other folds. ``score`` is
    the probability of true (0 or 1 for classifiers without one), ``prior`` the
    share of true in the training folds with one added to either class. The models are
    fitted when this is called.
    """
    if classifier not in CLASSIFIERS:
        raise ValueError(f"classifier must be one of {', '.join(CLASSIFIERS)}")
    if classifier in ESTIMATORS:
        return with_prior(stage(_fitted_per_fold(sparse, size, classifier, folds, models), "predictions"))
    data, used = _folded(stage(assign_folds(sparse, folds), "folded"))
    if classifier == "naive_bayes":
        result = naive_bayes(data, used, size, models.smoothing)
    else:
        result = grow_trees(data, used, models.max_depth, models.min_leaf).predictions()
    return with_prior(stage(result, "predictions"))


def decision_trees(
    sparse: DataFrame, folds: int = 10, models: ModelOptions = ModelOptions()
) -> Trees:
    """The trees that ``cross_validate`` predicts with."""
    data, used = _folded(stage(assign_folds(sparse, folds), "folded"))
    return grow_trees(data, used, models.max_depth, models.min_leaf)


def _folded(data: DataFrame) -> tuple[DataFrame, list[int]]:
    used = [r["fold"] for r in data.select("fold").distinct().orderBy("fold").collect()]
    if len(used) < 2:
        raise ValueError("cross-validation needs vectors in at least two folds")
    return data, used


def _fitted_per_fold(
    sparse: DataFrame, size: int, classifier: str, folds: int, models: ModelOptions
) -> DataFrame:
    """Predictions of Spark ML's models, ``models.parallel`` folds at a time."""
    data, fitted = _fitted(assign_folds(sparse, folds), size, classifier, models)
    parts = [model.transform(data.where(F.col("fold") == fold)) for fold, model in fitted.items()]
    predicted = reduce(DataFrame.unionByName, parts)
    if "probability" in predicted.columns:
        score = vector_to_array("probability")[1]
    else:
        score = F.col("prediction")
    return predicted.select(
        "a", "b", "label", "fold", score.alias("score"), (F.col("prediction") == 1).alias("prediction")
    )


def _fitted(
    folded: DataFrame, size: int, classifier: str, models: ModelOptions
) -> tuple[DataFrame, dict[int, Model]]:
    """The vectors for Spark ML and the model fitted without each fold."""
    # Both classes are declared, as a small training set may hold only one.
    classes = {"ml_attr": {"type": "nominal", "name": "target", "vals": ["false", "true"]}}
    data, used = _folded(ml_vectors(folded, size).withMetadata("target", classes))

    def fit(fold: int) -> Model:
        estimator = ESTIMATORS[classifier](models)
        estimator.setFeaturesCol("features").setLabelCol("target")
        model = estimator.fit(data.where(F.col("fold") != fold))
        _warn_unconverged(model, classifier, fold, models)
        return model

    with ThreadPoolExecutor(max(1, models.parallel)) as pool:
        jobs = {fold: pool.submit(copy_context().run, fit, fold) for fold in used}
        return data, {fold: job.result() for fold, job in jobs.items()}


def linear_models(
    sparse: DataFrame,
    size: int,
    classifier: str = "logistic",
    folds: int = 10,
    models: ModelOptions = ModelOptions(),
) -> LinearModels:
    """The models that ``cross_validate`` predicts with, as a table of weights."""
    if classifier not in ("logistic", "linear_svc"):
        raise ValueError("only logistic and linear_svc are linear models")
    folded = stage(assign_folds(sparse, folds), "folded")
    _, fitted = _fitted(folded, size, classifier, models)
    weights = stage(weights_table(sparse.sparkSession, fitted), "weights")
    penalty = models.reg_param if classifier == "linear_svc" else 0.0
    return LinearModels(folded, weights, list(fitted), classifier, penalty)


def with_prior(predictions: DataFrame) -> DataFrame:
    """Add ``prior``, the smoothed share of true outside the row's own fold."""
    counts = predictions.groupBy("fold").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("label").alias("_t")
    )
    all_n, all_t = F.sum("_n").alias("_all_n"), F.sum("_t").alias("_all_t")
    total = counts.agg(all_n, all_t)
    # One row per fold.
    priors = counts.select(
        "fold",
        (
            (total.select("_all_t").scalar() - F.col("_t") + 1)
            / (total.select("_all_n").scalar() - F.col("_n") + 2)
        ).alias("prior"),
    )
    return predictions.join(F.broadcast(priors), "fold").select(*predictions.columns, "prior")

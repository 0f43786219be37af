"""A bounded sample of labelled documents to fit a model on."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import column


@dataclass
class Sample:
    ids: list
    texts: list[str]
    labels: np.ndarray
    weights: np.ndarray  # of each row, so that the sample stands for all labelled rows


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learnable: Column,
    per_class: int,
    key: str = "doc_id",
    text: str = "text",
) -> Sample:
    """At most ``per_class`` documents of each label, those of least hash.

    ``learnable`` is a condition on the column ``key`` of the labels that says which of
    them may be used. An id with several labels has the larger one, one with several texts
    the largest. The ids of the sample are of bounded number, so they are broadcast, and
    only one text of each comes here.
    """
    known = (
        labels.select(column(labels, key, "key"), column(labels, label, "label"))
        .where(learnable & F.col("key").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("key")
        .agg(F.max("label").alias("label"))
    )
    totals = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value)
        part = part.orderBy(F.xxhash64("key"), "key").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    source = docs.select(column(docs, key, "key"), column(docs, text, "text"))
    found = source.join(F.broadcast(chosen), "key").groupBy("key", "label")
    rows = sorted(found.agg(F.max("text").alias("text")).collect(), key=lambda r: r.key)
    found = np.array([r.label for r in rows], np.int64)
    weights = np.ones(len(rows))
    for value in (0, 1):
        own = found == value
        if own.any():
            weights[own] = totals[value] / own.sum()
    return Sample([r.key for r in rows], [r.text or "" for r in rows], found, weights)


def share(key: str, parts: int) -> Column:
    """crc32 of an id's text modulo ``parts``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def fit_logistic(
    x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-2
) -> tuple[float, ...]:
    """Slopes and intercept of a weighted logistic curve over one feature or over the
    columns of several, by Newton's method."""
    design = np.column_stack([x, np.ones(len(x))])
    w = weights / weights.mean()
    beta = np.zeros(design.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (w * (p - y)) + ridge * beta
        hessian = (design * (w * p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        beta = beta - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)

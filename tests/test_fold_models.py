"""Models of all folds at once: against row-by-row versions and against Spark ML."""

import math
import random

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pathfeat.operators import classify
from pathfeat.operators.bayes import naive_bayes, path_counts
from pathfeat.operators.classify import ModelOptions, cross_validate, ml_vectors
from pathfeat.operators.tree import grow_trees

SCHEMA = "a string, b string, label boolean, fold int, cells array<struct<id:bigint,n:bigint>>"
FOLDS = [0, 1, 2, 3]


def _rows(seed, n=120, paths=6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        cells = [(p, rng.randint(1, 4)) for p in range(paths) if rng.random() < 0.4] or [(paths, 1)]
        label = (dict(cells).get(1, 0) >= 2) != (rng.random() < 0.2)
        rows.append((f"a{i:03}", "b", label, rng.choice(FOLDS), cells))
    return rows


def _spread(n, t):
    part = lambda x: x * math.log2(x) if x else 0.0
    return part(n) - part(t) - part(n - t)


def _tree(rows, node, depth, max_depth, min_leaf, out):
    n, t = len(rows), sum(r[2] for r in rows)
    best = None
    if depth < max_depth:
        for p in {c[0] for r in rows for c in r[4]}:
            held = [dict(r[4]).get(p, 0) for r in rows]
            for at in sorted(set(held) - {0}):
                right = [r for r, x in zip(rows, held) if x >= at]
                rn, rt = len(right), sum(r[2] for r in right)
                if min(rn, n - rn) < min_leaf:
                    continue
                gain = round((_spread(n, t) - _spread(rn, rt) - _spread(n - rn, t - rt)) / n, 12)
                if gain > 0 and (best is None or (-gain, p, at) < best):
                    best = (-gain, p, at)
    if best is None:
        out[node] = (n, t, None, None)
        return
    _, p, at = best
    out[node] = (n, t, p, at)
    side = lambda r: dict(r[4]).get(p, 0) >= at
    _tree([r for r in rows if not side(r)], 2 * node, depth + 1, max_depth, min_leaf, out)
    _tree([r for r in rows if side(r)], 2 * node + 1, depth + 1, max_depth, min_leaf, out)


def _predicted(tree, cells):
    node, cells = 1, dict(cells)
    while tree[node][2] is not None:
        node = 2 * node + (cells.get(tree[node][2], 0) >= tree[node][3])
    return tree[node][1] / tree[node][0]


@pytest.mark.parametrize("seed, max_depth, min_leaf", [(1, 2, 2), (2, 8, 1), (3, 5, 6), (4, 0, 2)])
def test_trees_row_by_row(spark, seed, max_depth, min_leaf):
    rows = _rows(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    grown = grow_trees(frame, [*FOLDS, 9], max_depth, min_leaf)
    got = {(r.tree, r.node): (r.n, r.n_true, r.id, r.at) for r in grown.table().collect()}
    want, trees = {}, {}
    for f in [*FOLDS, 9]:
        trees[f] = {}
        _tree([r for r in rows if r[3] != f], 1, 0, max_depth, min_leaf, trees[f])
        want |= {(f, node): x for node, x in trees[f].items()}
    assert got == want
    scores = {r.a: (r.score, r.prediction) for r in grown.predictions().collect()}
    for a, _, _, fold, cells in rows:
        score = _predicted(trees[fold], cells)
        assert scores[a] == (pytest.approx(score), score > 0.5)


def test_one_job_a_level_for_all_folds(spark):
    frame = spark.createDataFrame(_rows(5, 200), SCHEMA)
    text = grow_trees(frame, FOLDS, 1).rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text
    from pathfeat.operators.tree import histograms

    rows = frame.withColumn("slots", F.lit([0] * len(FOLDS)).cast("array<int>"))
    counts = histograms(rows, FOLDS)
    # Two aggregates, not one per fold, and neither grows with the number of trees.
    assert counts._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    totals = {(r.tree, r.slot) for r in counts.select("tree", "slot").distinct().collect()}
    assert totals == {(k, 0) for k in range(len(FOLDS))}


def test_trees_of_odd_tables(spark):
    one = spark.createDataFrame([("a", "b", True, 0, [(0, 1)])], SCHEMA)
    (row,) = grow_trees(one, [0, 1]).predictions().collect()
    assert row.score == 0 and not row.prediction
    none = grow_trees(one.where("false"), [0, 1])
    assert none.predictions().count() == 0 and none.table().count() == 2
    alike = spark.createDataFrame([(str(i), "b", i < 3, i % 2, [(0, 7)]) for i in range(10)], SCHEMA)
    assert {r.node for r in grow_trees(alike, [0, 1]).table().collect()} == {1}
    with pytest.raises(ValueError):
        grow_trees(one, [0, 1], min_leaf=0)


@pytest.mark.parametrize("smoothing", [1.0, 0.25])
def test_naive_bayes_equals_fitted_models(spark, smoothing):
    rows = _rows(7, 150)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.a: r for r in naive_bayes(frame, FOLDS, 8, smoothing).collect()}
    classes = {"ml_attr": {"type": "nominal", "name": "target", "vals": ["false", "true"]}}
    data = ml_vectors(frame, 8).withMetadata("target", classes)
    seen = 0
    for fold in FOLDS:
        estimator = NaiveBayes(modelType="multinomial", smoothing=smoothing).setLabelCol("target")
        model = estimator.fit(data.where(F.col("fold") != fold))
        found = model.transform(data.where(F.col("fold") == fold))
        for r in found.select("a", "prediction", vector_to_array("probability")[1].alias("p")).collect():
            assert got[r.a].score == pytest.approx(r.p, abs=1e-9)
            assert got[r.a].prediction == (r.prediction == 1)
            seen += 1
    assert seen == len(rows) == len(got)


def test_path_counts_add_up_by_fold(spark):
    rows = _rows(8)
    counts = {r.id: r for r in path_counts(spark.createDataFrame(rows, SCHEMA), FOLDS).collect()}
    for p, r in counts.items():
        for k, fold in enumerate(FOLDS):
            for label, got in ((True, r.true[k]), (False, r.false[k])):
                assert got == sum(dict(x[4]).get(p, 0) for x in rows if x[2] == label and x[3] == fold)


def test_folds_without_a_class(spark):
    rows = [(str(i), "b", i == 0, i % 2, [(i % 3, 1)]) for i in range(10)]
    got = naive_bayes(spark.createDataFrame(rows, SCHEMA), [0, 1], 3).collect()
    assert len(got) == 10 and all(0 < r.score < 1 for r in got)


def test_unknown_classifier(spark):
    frame = spark.createDataFrame(_rows(1, 10), SCHEMA).drop("fold")
    with pytest.raises(ValueError, match="classifier must be one of"):
        cross_validate(frame, 7, "oracle")
    assert set(classify.ESTIMATORS) < set(classify.CLASSIFIERS)
    got = cross_validate(frame, 7, "decision_tree", 2, ModelOptions(max_depth=1, min_leaf=1))
    assert got.columns == ["a", "b", "label", "fold", "score", "prediction", "prior"]

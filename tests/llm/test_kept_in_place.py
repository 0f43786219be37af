"""Near-dedup in the pipeline leaves the texts it keeps where they are read."""

import random

import pytest
from cases import AWKWARD
from test_minhash import brute

import corpus_pipeline


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(21)
    texts = [" ".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=60)) for _ in range(400)]
    texts += [t + " more" for t in texts[:30]] + texts[30:40]
    return list(enumerate(texts)) + [(k if k is None else 5000 + k, t) for k, t in AWKWARD]


def text_rows_shuffled(df):
    """Rows that the exchanges of the query that ran carry a text in."""
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind in ("ShuffleQueryStageExec", "ResultQueryStageExec"):
            todo.append(node.plan())
        elif kind == "ShuffleExchangeExec" and "text#" in node.output().mkString(" "):
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


@pytest.mark.parametrize("slots", [None, 128])
def test_only_suspects_are_shuffled(spark, rows, monkeypatch, slots):
    if slots:  # so few that kept ids have the bits of dropped ones
        monkeypatch.setattr(corpus_pipeline, "_SLOTS", slots)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        left = corpus_pipeline.drop_near_duplicates(spark, docs.localCheckpoint(), "")
        got = sorted([tuple(r) for r in left.collect()], key=str)
    finally:
        spark.conf.set(key, before)
    kept = {r[0] for r in brute(rows) if r[3]}
    assert got == sorted([r for r in rows if r[0] in kept], key=str)
    gone = sum(r[0] not in kept for r in rows)
    assert gone >= 40
    shuffled = text_rows_shuffled(left)
    assert gone < shuffled < len(rows) if slots else gone <= shuffled <= gone + 2

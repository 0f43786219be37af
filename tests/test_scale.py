"""Numbering, evaluation and the shape of the plans."""

import math

import pytest
from pyspark.sql import functions as F

from pathfeat import FeaturePlan, Options
from pathfeat.operators import evaluate
from pathfeat.operators.classify import CLASSIFIERS, ModelOptions, assign_folds, cross_validate
from pathfeat.operators.numbering import dense_ids, running_totals
from pathfeat.plans import staging


def test_dense_ids_over_many_partitions(spark):
    df = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("k")).repartition(13)
    got = dense_ids(df, ["k"], start=1).collect()
    assert [r["id"] for r in sorted(got, key=lambda r: r["k"])] == list(range(1, 5001))


def test_running_totals(spark):
    df = spark.range(3000).select("id", (F.col("id") * 7 % 11).alias("v")).repartition(9)
    got = {r["id"]: r["t"] for r in running_totals(df, [F.desc("id")], {"t": "v"}).collect()}
    total = 0
    for i in range(2999, -1, -1):
        total += i * 7 % 11
        assert got[i] == total


class FakeSession:
    def __init__(self, master, folder=None, context_folder=None):
        self.conf = {staging.CHECKPOINT_DIR: folder} if folder else {}
        self.sparkContext = self
        self.master = master
        self.getCheckpointDir = lambda: context_folder


def test_staging_folder(spark):
    shared = FakeSession("spark://host:7077", "hdfs://shared/folder/")
    assert staging.staging_root(shared) == "hdfs://shared/folder"
    assert staging.staging_root(FakeSession("local[4]")).startswith("/")
    # First the folder asked for, then the context's, then the setting's.
    both = FakeSession("spark://host:7077", "hdfs://shared/folder", "hdfs://context/x")
    assert staging.staging_root(both) == "hdfs://context/x"
    with staging.Staging("hdfs://own/"):
        assert staging.staging_root(both) == "hdfs://own"
    assert staging.staging_root(both) == "hdfs://context/x"
    # A cluster without a shared folder never gets a folder of one machine.
    assert staging.staging_root(FakeSession("spark://host:7077")) is None
    root = staging.staging_root(spark)
    staged = staging.stage(spark.range(5), "t")
    folder = root.split(":", 1)[-1].lstrip("/")
    assert all(f"{folder}/pathfeat/t-" in f for f in staged.inputFiles())
    assert staged.count() == 5


def test_rows_are_persisted_where_there_is_no_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda spark: None)
    df = spark.range(100).select(F.hash("id").alias("k")).repartition(7)
    got = sorted(dense_ids(df, ["k"]).collect())
    assert [r["id"] for r in got] == list(range(100))


def test_staged_tables_can_be_deleted(sample, tmp_path):
    with FeaturePlan(*sample, Options(dpmin=1), staging=f"file://{tmp_path}") as plan:
        assert plan.found.count() > 0
        plan.arff_lines().collect()
        staged = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "pathfeat").iterdir()}
        assert staged == {"cells", "sorted", "vocabulary", "pairs", "found"}
    assert list((tmp_path / "pathfeat").iterdir()) == []


def predictions(spark, n=400):
    score = (F.col("id") * 37 % 19) / 18.0
    label = (F.col("id") * 13 % 7) / 7.0 + score > 0.9
    df = spark.range(n).select(
        F.col("id").cast("string").alias("a"), F.lit("b").alias("b"), label.alias("label"),
        score.alias("score"), (score > 0.5).alias("prediction"), F.lit(0.4).alias("prior"),
    )
    return df.repartition(5)


def test_summary_and_details(spark):
    df = predictions(spark)
    data = df.collect()
    n = len(data)
    tp = sum(r["label"] and r["prediction"] for r in data)
    fp = sum(not r["label"] and r["prediction"] for r in data)
    fn = sum(r["label"] and not r["prediction"] for r in data)
    tn = n - tp - fp - fn
    s = evaluate.summary(df).first()
    assert (s["n"], s["correct"], s["incorrect"]) == (n, tp + tn, fp + fn)
    chance = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / n**2
    assert math.isclose(s["kappa"], ((tp + tn) / n - chance) / (1 - chance))
    mae = sum(abs(r["score"] - r["label"]) for r in data) / n
    mae0 = sum(abs(0.4 - r["label"]) for r in data) / n
    assert math.isclose(s["mae"], mae)
    assert math.isclose(s["relative_absolute_error"], 100 * mae / mae0)

    details = {r["class"]: r for r in evaluate.class_details(df).collect()}
    assert math.isclose(details[True]["precision"], tp / (tp + fp))
    assert math.isclose(details[False]["recall"], tn / (tn + fp))
    won = sum(
        (x["score"] > y["score"]) + 0.5 * (x["score"] == y["score"])
        for x in data if x["label"] for y in data if not y["label"]
    )
    roc = won / ((tp + fn) * (fp + tn))
    assert math.isclose(details[True]["roc_area"], roc)
    assert math.isclose(details[False]["roc_area"], roc)

    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    plain = df.select(F.col("score").alias("rawPrediction"), F.col("label").cast("double").alias("label"))
    theirs = BinaryClassificationEvaluator(numBins=0).evaluate(plain)
    assert math.isclose(details[True]["roc_area"], theirs, rel_tol=1e-9)


def test_perfect_and_empty_predictions(spark):
    df = predictions(spark).withColumn("prediction", F.col("label")).withColumn(
        "score", F.col("label").cast("double")
    )
    for r in evaluate.class_details(df).collect():
        assert (r["roc_area"], r["prc_area"], r["mcc"], r["f1"]) == (1, 1, 1, 1)
    empty = evaluate.summary(df.where("false")).first()
    assert empty["n"] == 0 and empty["kappa"] is None


def test_samples(spark):
    df = predictions(spark)
    got = evaluate.confusion_samples(df, 3).collect()
    assert len(got) == 12
    first = sorted(r["a"] for r in df.collect() if r["label"] and r["prediction"])[:3]
    assert sorted(r["a"] for r in got if r["bucket"] == "tp") == first
    plan = evaluate.confusion_samples(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_folds_are_even_per_label(spark):
    df = predictions(spark).select("a", "b", "label")
    sizes = assign_folds(df, 10).groupBy("label", "fold").count().collect()
    for label in (True, False):
        counts = [r["count"] for r in sizes if r["label"] == label]
        assert len(counts) == 10 and max(counts) - min(counts) <= 1


@pytest.mark.parametrize("shared_folder", [True, False])
@pytest.mark.parametrize("classifier", sorted(CLASSIFIERS))
def test_classifiers_learn_a_plain_rule(spark, monkeypatch, classifier, shared_folder):
    if not shared_folder:
        monkeypatch.setattr(staging, "staging_root", lambda spark: None)
    # The label is the presence of path 1; every vector also holds a common path.
    sparse = spark.range(80).select(
        F.col("id").cast("string").alias("a"),
        F.lit("b").alias("b"),
        (F.col("id") % 2 == 0).alias("label"),
        F.expr(
            "array(named_struct('id', IF(id % 2 = 0, 1L, 0L), 'n', 1 + id % 3), "
            "named_struct('id', 4L, 'n', 1L))"
        ).alias("cells"),
    )
    got = cross_validate(sparse, 5, classifier, folds=2)
    assert got.count() == 80
    assert got.where("label <> prediction").count() == 0


def test_unconverged_fits_are_told(spark):
    sparse = spark.range(60).select(
        F.col("id").cast("string").alias("a"),
        F.lit("b").alias("b"),
        (F.col("id") % 3 == 0).alias("label"),
        F.expr("array(named_struct('id', id % 5, 'n', 1 + id % 4))").alias("cells"),
    )
    with pytest.warns(UserWarning, match="not converged after 1 iterations"):
        cross_validate(sparse, 5, "logistic", folds=2, models=ModelOptions(max_iter=1))
    tree = cross_validate(sparse, 5, "decision_tree", folds=2, models=ModelOptions(max_depth=0))
    assert tree.select("fold", "score").distinct().count() == 2


@pytest.fixture(scope="module")
def plan(sample):
    return FeaturePlan(*sample, Options(dpmin=1))


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_pair_products(plan):
    for name in (
        "records", "support", "vocabulary", "kept_records", "numbered_pairs", "found",
        "label_join", "without_evidence", "sparse", "vectors", "dense_cells",
    ):
        text = executed(getattr(plan, name))
        for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
            assert node not in text, (name, node)


def test_exchanges(plan):
    from pathfeat.operators import features, vocabulary

    # Extraction is narrow, counting shuffles once, support once more on counts.
    assert executed(plan.records).count("Exchange") == 0
    # The vocabulary is joined before the labels.
    cells = vocabulary.path_cells(plan.records)
    assert executed(cells).count("Exchange") == 1
    assert executed(plan.support).count("Exchange") == 1
    # Small staged sides are broadcast because of their size, not of a hint.
    found = features.labelled_cells(plan.cells, plan.vocabulary, plan.pairs, plan.options)
    assert executed(found).count("BroadcastHashJoin") == 2


def test_large_sides_are_not_broadcast(spark, plan):
    from pathfeat.operators import features

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = features.labelled_cells(plan.cells, plan.vocabulary, plan.pairs, plan.options)
        text = executed(found)
        assert "BroadcastHashJoin" not in text and text.count("SortMergeJoin") == 2
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plan.found.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scan_reads_needed_columns_only(spark):
    from workload.queries import path_cells

    text = path_cells(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in text.replace("...", "")


def test_a_common_path_is_split_when_sides_are_shuffled(spark):
    from pathfeat.operators.features import numbered_pairs

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        path = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 500).cast("string"))
        word = F.sha2(F.col("id").cast("string"), 256)
        records = spark.range(60_000).select(path.alias("dp"), word.alias("a"), F.lit("b").alias("b"))
        vocabulary = dense_ids(records.select("dp").distinct(), ["dp"])
        joined = numbered_pairs(records.repartition(12), vocabulary, Options(symmetric=False))
        assert len(joined.collect()) == 60_000
        assert "skew=true" in executed(joined)
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_arff_holds_no_zeros_before_the_text(sample, monkeypatch):
    from pathfeat.operators import numbering

    staged = []
    real = staging.stage

    def watch(df, name, schema=None):
        staged.append((name, df.columns))
        return real(df, name, schema)

    monkeypatch.setattr(numbering, "stage", watch)
    plan = FeaturePlan(*sample, Options(dpmin=1))
    lines = plan.arff_lines()
    assert staged and not any("features" in c or "value" in c for _, c in staged)
    assert lines.count() == 10


def test_the_corpus_is_walked_once(spark, tmp_path, sample):
    from conftest import SAMPLE_ARCS, SAMPLE_LABELS
    from pathfeat import run

    (tmp_path / "arcs").write_text("\n".join(SAMPLE_ARCS))
    (tmp_path / "labels").write_text("\n".join(SAMPLE_LABELS))
    plan = run(
        spark, str(tmp_path / "arcs"), str(tmp_path / "labels"), str(tmp_path / "out"), Options(dpmin=1),
        classifier=None, write_records=True, write_rejects=False,
    )
    for name in ("cells", "kept_records", "numbered_pairs", "found"):
        assert "arcs" not in executed(getattr(plan, name)).replace("path", ""), name
    again = FeaturePlan.from_tables(
        spark.read.parquet(str(tmp_path / "out/cells")),
        spark.read.parquet(str(tmp_path / "out/vocabulary")),
        plan.labels,
        Options(dpmin=1),
    )
    assert sorted(map(tuple, again.vectors.collect())) == sorted(map(tuple, plan.vectors.collect()))
    with pytest.raises(ValueError, match="corpus"):
        again.records

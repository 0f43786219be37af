"""Tables dealt by pair, runs that go on where an earlier one stopped, files made of parts."""

import glob
import os
import random

import pytest

from conftest import SAMPLE_ARCS, SAMPLE_LABELS
from pathfeat import FeaturePlan, Options, run
from pathfeat.operators.parse import parse_arcs, parse_labels
from pathfeat.plans.staging import Staging, stage_by


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def executed(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # After adaptive execution the first plan is printed as well.
    return plan.split("+- == Initial Plan ==")[0]


def _corpus(seed, n):
    rnd = random.Random(seed)
    words = "ox cat dog hen emu ram eel ant bee cow".split()
    make = lambda: f"{rnd.choice(words)}\t{rnd.choice(words)}/NN/d/0 {rnd.choice(['by'] + ['as'] * 12)}/IN/p/1 {rnd.choice(words)}/NN/d/2"
    pairs = [f"{x} {y} {str((i + j) % 3 == 0).lower()}" for i, x in enumerate(words) for j, y in enumerate(words) if i != j]
    return [make() for _ in range(n)], [*pairs, "cow ufo true"]


def _plan(spark, seed=3, **settings):
    arcs, labels = _corpus(seed, 300)
    arc_lines = spark.createDataFrame(list(enumerate(arcs)), "line_id bigint, value string")
    label_lines = spark.createDataFrame([(x,) for x in labels], "value string")
    return FeaturePlan(parse_arcs(arc_lines), parse_labels(label_lines), Options(dpmin=2, path_format="word_label"), **settings)


@pytest.mark.parametrize("shared_folder", [True, False])
def test_pairs_are_shuffled_once(spark, tmp_path, monkeypatch, shared_folder):
    if not shared_folder:
        monkeypatch.setattr("pathfeat.plans.staging.staging_root", lambda spark: None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with _plan(spark, buckets=3, staging=str(tmp_path)) as plan:
            assert plan.pairs.count() == 91 and plan.found.count() > 91
            for name in ("sparse", "label_join", "without_evidence"):
                text = executed(getattr(plan, name))
                assert "Exchange hashpartitioning" not in text.split("InMemoryRelation")[0], name
            assert plan.sparse.rdd.getNumPartitions() == 3
            want = _rows(plan.label_join)
        with _plan(spark, buckets=7, staging=str(tmp_path)) as other:
            assert _rows(other.label_join) == want and len(want) > 91
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dealt_tables_are_dropped(spark, tmp_path):
    before = len(spark.catalog.listTables())
    rows = spark.range(100).selectExpr("id", "id % 3 as k")
    with Staging(str(tmp_path)) as scope:
        table = stage_by(rows, "dealt", ["k"], 4)
    # One key is in one file, and no task wrote more than one.
    assert len(glob.glob(f"{tmp_path}/pathfeat/dealt-*/part-*")) <= 3 and _rows(table) == _rows(rows)
    assert len(spark.catalog.listTables()) == before + 1
    scope.close()
    assert len(spark.catalog.listTables()) == before and not os.listdir(tmp_path / "pathfeat")
    with Staging(str(tmp_path)) as scope:
        assert stage_by(rows.where("false"), "dealt", ["k"]).count() == 0
    scope.close()


def _files(tmp_path, seed=5):
    arcs, labels = _corpus(seed, 300)
    (tmp_path / "arcs").write_text("\n".join([*arcs, "bad"]))
    (tmp_path / "labels").write_text("\n".join(labels))
    return str(tmp_path / "arcs"), str(tmp_path / "labels")


OPTIONS = Options(dpmin=2, path_format="word_label")


def test_a_broken_run_goes_on(spark, tmp_path, monkeypatch):
    from pathfeat.plans import outputs, pipeline

    corpus, labels = _files(tmp_path)
    kwargs = {"classifier": "naive_bayes", "folds": 3, "staging": str(tmp_path / "staging")}
    whole = run(spark, corpus, labels, str(tmp_path / "whole"), OPTIONS, **kwargs)
    out, made = str(tmp_path / "out"), []
    real = outputs.Outputs.make

    def watched(self, name, mark, write):
        if name == "vocabulary" and not made.count("vocabulary"):
            made.append(name)
            (tmp_path / "out" / "vocabulary").mkdir()
            (tmp_path / "out" / "vocabulary" / "part-half").write_text("half of it")
            raise KeyboardInterrupt
        done = len(self.made)
        real(self, name, mark, write)
        made.extend(self.made[done:])

    monkeypatch.setattr(outputs.Outputs, "make", watched)
    with pytest.raises(KeyboardInterrupt):
        run(spark, corpus, labels, out, OPTIONS, write_rejects=False, resume=True, **kwargs)
    assert made == ["cells", "frequent_paths", "vocabulary"]
    with monkeypatch.context() as m:
        m.setattr(pipeline, "read_lines", lambda *_: pytest.fail("the corpus was read"))
        plan = run(spark, corpus, labels, out, OPTIONS, write_rejects=False, resume=True, **kwargs)
        for step in ("cells", "vocabulary", "sparse"):
            assert _rows(getattr(plan, step)) == _rows(getattr(whole, step)), step
        for name in ("label_join", "predictions", "samples"):
            assert _rows(spark.read.parquet(f"{out}/{name}")) == _rows(spark.read.parquet(f"{tmp_path}/whole/{name}"))
        # Nothing is left to make.
        del made[:]
        made.append("vocabulary")
        run(spark, corpus, labels, out, OPTIONS, write_rejects=False, resume=True, **kwargs).close()
        assert made == ["vocabulary"]
        # Another threshold starts from the cells, other folds from the vectors.
        run(spark, corpus, labels, out, OPTIONS, write_rejects=False, resume=True, **{**kwargs, "folds": 4}).close()
        assert made[1:] == ["predictions", "summary", "class_details", "weighted_average", "samples"]
        other = run(spark, corpus, labels, out, OPTIONS.but(dpmin=50), write_rejects=False, resume=True, **kwargs)
        assert "cells" not in made and {"frequent_paths", "vectors", "arff"} <= set(made)
        assert 0 < other.vocabulary.count() < whole.vocabulary.count()
    plan.close(), whole.close(), other.close()
    # Other files are read.
    _files(tmp_path, seed=6)
    del made[1:]
    run(spark, corpus, labels, out, OPTIONS, write_rejects=False, resume=True, **kwargs).close()
    assert "cells" in made


def test_results_are_never_replaced_unasked(spark, tmp_path):
    from pathfeat.plans.outputs import Outputs

    rows = spark.range(3)
    Outputs(spark, str(tmp_path)).table("t", "mark", lambda: rows)
    with pytest.raises(Exception, match="already exists"):
        Outputs(spark, str(tmp_path)).table("t", "mark", lambda: rows)
    assert Outputs(spark, str(tmp_path), resume=True).table("t", "mark", lambda: pytest.fail("made")).count() == 3
    assert Outputs(spark, str(tmp_path), resume=True).table("t", "other", lambda: rows.limit(1)).count() == 1
    with pytest.raises(ValueError, match="no step"):
        FeaturePlan(None).adopt("options", rows)


def test_sparse_arff(spark, sample, tmp_path):
    from pathfeat.sources import arff

    with FeaturePlan(*sample, Options(dpmin=1), staging=str(tmp_path / "staging")) as plan:
        plan.write_arff(str(tmp_path / "arff"), "sparse")
        document = "".join(open(p).read() for p in sorted(glob.glob(f"{tmp_path}/arff/*/part-*")))
        assert document.split("@DATA\n")[1] == "%1\tchair\tfurnitur\n{0 1, 2 1, 3 True}\n%2\tsofa\tfurnitur\n{0 1, 3 True}\n"
        read = arff.read_sparse_arff_pairs(spark, str(tmp_path / "arff"))
        assert _rows(read.select("a", "b", "label", "cells")) == _rows(plan.sparse)
        assert arff.read_sparse_arff(spark, str(tmp_path / "arff")).count() == 2
        # No line is made of as many parts as there are paths.
        assert "array_repeat" not in plan.arff_lines("sparse")._jdf.queryExecution().analyzed().toString()
    odd = ["{}", "{ 7  2 ,1 0, 3 5}", "{2 False}", "% {1 2}", "@DATA", "1,2,True", "", None, "{1 2, 9 true}"]
    got = arff.parse_sparse_arff(spark.createDataFrame([(v,) for v in odd], "value string"))
    assert [([tuple(c) for c in r.cells], r.label) for r in got.collect()] == [
        ([], True), ([(3, 5), (7, 2)], True), ([], False), ([(1, 2)], True),
    ]


def test_parts_are_the_document(spark, tmp_path, monkeypatch):
    from pathfeat.sources import parts

    with _plan(spark, staging=str(tmp_path / "staging")) as plan:
        plan.write_arff(str(tmp_path / "arff"))
    names = sorted(glob.glob(f"{tmp_path}/arff/*/part-*"))
    document = b"".join(open(p, "rb").read() for p in names)
    listed = parts.part_list(spark, str(tmp_path / "arff")).orderBy("first").collect()
    assert len(listed) > 1 and sum(r.length for r in listed) == len(document)
    for r in listed:
        assert open(r.path.removeprefix("file:"), "rb").read() == document[r.first : r.first + r.length]
    # A local file system doesn't join files: nothing is changed.
    target = str(tmp_path / "one.arff")
    assert not parts.join_parts(spark, str(tmp_path / "arff"), target)
    assert not os.path.exists(target) and sorted(glob.glob(f"{tmp_path}/arff/*/part-*")) == names
    open(target, "w").close()
    with pytest.raises(ValueError, match="already"):
        parts.join_parts(spark, str(tmp_path / "arff"), target)

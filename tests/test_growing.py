"""Support bounds before the shuffle, lines read once, corpora that grow."""

import os

import pytest
from conftest import SAMPLE_ARCS, SAMPLE_LABELS
from pyspark.sql import functions as F

from pathfeat import FeaturePlan, Options, run
from pathfeat.operators import sketch
from pathfeat.operators.parse import parse_arcs, reject_arcs
from pathfeat.operators.vocabulary import path_cells, path_support
from pathfeat.plans.staging import Staging
from pathfeat.plans.store import CellStore
from pathfeat.sources.routed import stage_routed


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _text(seed, n):
    from test_paths import random_lines

    return [f"{h}\t" + " ".join("/".join(map(str, t)) for t in toks) for h, toks in random_lines(seed, n)]


@pytest.fixture(scope="module")
def records(spark):
    # One path with many pairs, one with many records of one pair, and thousands of rare ones.
    hot = spark.range(3000).select(F.lit("hot").alias("dp"), F.col("id").cast("string").alias("a"), F.lit("b").alias("b"))
    one = spark.range(50).select(F.lit("one pair").alias("dp"), F.lit("a").alias("a"), F.lit("b").alias("b"))
    rare = spark.range(20_000).select(
        F.concat(F.lit("rare"), F.col("id")).alias("dp"), F.lit("a").alias("a"), F.lit("b").alias("b")
    )
    return hot.unionByName(one).unionByName(rare).repartition(4)


@pytest.mark.parametrize("slots", [64, 1024, 1 << 18])
def test_bounds_are_never_too_low(spark, records, slots):
    counters = {r.slot: r.n for r in sketch.support_sketch(records, slots, 3).collect()}
    assert sum(counters.values()) == 3 * records.count()
    exact = records.groupBy("dp").count()
    for r in range(3):
        bound = exact.select("count", (sketch._slot(F.col("dp"), r, slots) + r * slots).alias("slot"))
        assert all(counters[x.slot] >= x["count"] for x in bound.collect())


@pytest.mark.parametrize("slots", [64, 1 << 18])
def test_pruned_support_is_the_same_where_it_counts(spark, records, slots):
    bits = sketch.heavy_bits(sketch.support_sketch(records, slots), 40, slots)
    bits = spark.createDataFrame(bits.collect(), bits.schema)
    kept = sketch.possibly_frequent(records, bits, slots)
    frequent = lambda r: path_support(path_cells(r)).where("n_pairs >= 40")
    assert _rows(frequent(kept)) == _rows(frequent(records)) == [("hot", 3000, 3000)]
    if slots > 64:
        assert kept.count() < 3200
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan


def test_sketches_add_up(records):
    first, second = records.where("a = '1'"), records.where("a <> '1'")
    merged = sketch.merge_sketches(sketch.support_sketch(first, 256), sketch.support_sketch(second, 256))
    assert _rows(merged) == _rows(sketch.support_sketch(records, 256))
    with pytest.raises(ValueError, match="multiple of 64"):
        sketch.heavy_bits(merged, 1, slots=100)




def test_pruned_plan_shuffles_less(spark, tmp_path):
    lines = spark.createDataFrame(list(enumerate(_text(5, 2000))), "line_id bigint, value string")
    options = Options(dpmin=6, path_format="word_pos_label")
    with FeaturePlan(parse_arcs(lines), options=options) as whole, FeaturePlan(
        parse_arcs(lines), options=options, prune=True
    ) as pruned:
        assert _rows(pruned.frequent) == _rows(whole.frequent)
        assert _rows(pruned.vocabulary) == _rows(whole.vocabulary)
        # A row of the cells is a row of the shuffle, or more.
        assert pruned.cells.count() < whole.cells.count() / 2
        assert pruned.frequent.count() > 0


def test_lines_are_read_once(spark, tmp_path):
    text = [*_text(3, 300), "", "bad", "head\tno/slashes"]
    lines = spark.createDataFrame(list(enumerate(text)), "line_id bigint, value string")
    reads = spark.sparkContext.accumulator(0)

    def seen(value):
        reads.add(1)
        return value

    watched = lines.select("line_id", F.udf(seen, "string")("value").alias("value"))
    with Staging(str(tmp_path)) as scope:
        routed = stage_routed(watched, scope)
        assert _rows(routed.arcs) == _rows(parse_arcs(lines))
        assert _rows(routed.rejects) == _rows(reject_arcs(lines))
        assert (routed.n_arcs, routed.n_rejects) == (routed.arcs.count(), routed.rejects.count())
        assert reads.value == len(text)
    for kind, other in (("arcs", "reject"), ("rejects", "arc")):
        files = getattr(routed, kind).inputFiles()
        plan = getattr(routed, kind)._jdf.queryExecution().executedPlan().toString()
        assert files and "PartitionFilters: [isnotnull(kind" in plan, other
    scope.close()
    assert not os.listdir(tmp_path / "pathfeat")


def test_routed_without_arcs_or_folder(spark, tmp_path, monkeypatch):
    none = spark.createDataFrame([(1, "bad")], "line_id bigint, value string")
    with Staging(str(tmp_path)) as scope:
        routed = stage_routed(none, scope)
        assert routed.arcs.count() == 0 and routed.rejects.count() == 1
        empty = stage_routed(none.where("false"), scope)
        assert empty.arcs.count() == empty.rejects.count() == empty.n_arcs == 0
    monkeypatch.setattr("pathfeat.sources.routed.staging_root", lambda spark: None)
    scope = Staging()
    routed = stage_routed(none, scope)
    assert (routed.n_arcs, routed.n_rejects, routed.rejects.count()) == (0, 1, 1)
    scope.close()


def test_run_reads_the_corpus_once(spark, tmp_path):
    (tmp_path / "arcs").write_text("\n".join([*SAMPLE_ARCS, "bad"]))
    (tmp_path / "labels").write_text("\n".join(SAMPLE_LABELS))
    out = str(tmp_path / "out")
    plan = run(
        spark, str(tmp_path / "arcs"), str(tmp_path / "labels"), out, Options(dpmin=1),
        classifier=None, write_records=True, kept_paths_only=True, staging=str(tmp_path / "staging"),
    )
    # Whatever the plan is asked for now, none of it goes back to the lines.
    for name in ("arcs", "cells", "kept_records", "numbered_pairs", "found"):
        assert not any(f.endswith("/arcs") for f in getattr(plan, name).inputFiles()), name
    assert _rows(spark.read.parquet(f"{out}/line_counts")) == [("arcs", 4), ("rejects", 1)]
    assert _rows(spark.read.parquet(f"{out}/rejected_lines").select("value")) == [("bad",)]
    plan.close()


def test_additions_equal_one_run(spark, tmp_path):
    corpus, text = tmp_path / "corpus", _text(7, 400)
    corpus.mkdir()
    store = CellStore(spark, str(tmp_path / "store"), Options(dpmin=1))
    assert store.cells.count() == 0
    (corpus / "a").write_text("\n".join(text[:100]))
    assert store.add(f"{corpus}/*") == 1
    (corpus / "b").write_text("\n".join(text[100:]))
    (corpus / "c").write_text("")
    # A file without content has nothing to read.
    assert store.unread(f"{corpus}/*").count() == 1
    assert store.add(f"{corpus}/*") == 1 and store.add(f"{corpus}/*") == 0
    lines = spark.createDataFrame(list(enumerate(text)), "line_id bigint, value string")
    want = FeaturePlan(parse_arcs(lines), options=Options(dpmin=1)).cells
    assert _rows(store.cells) == _rows(want) and want.count() > 50
    assert store.manifest.count() == 2
    # An addition whose files are not in the manifest does not count.
    broken = want.withColumn("addition", F.lit("broken"))
    broken.write.partitionBy("addition").mode("append").parquet(f"{store.root}/cells")
    assert _rows(store.cells) == _rows(want)
    (corpus / "a").write_text("changed")
    with pytest.raises(ValueError, match="has changed"):
        store.add(f"{corpus}/*")

"""Queries that need several things of a corpus derive and walk it once."""

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from pathfeat import Options
from pathfeat.operators.parse import parse_arcs
from pathfeat.operators.paths import path_records
from pathfeat.plans import pipeline
from workload import queries

TEXTS = ["ponies agreed with matting and mating of the cats in meetings", "one", "", None, "cats with ponies " * 9]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    documents = spark.createDataFrame(list(enumerate(TEXTS * 4)), "doc_id bigint, text string")
    documents.write.parquet(f"{path}/documents.parquet")
    for name in ("conversations", "benchmark"):
        documents.where("doc_id % 5 = 0").select("text").write.parquet(f"{path}/{name}.parquet")
    return path


def derives(df):
    return "regexp_extract_all" in df._jdf.queryExecution().executedPlan().toString()


def test_word_paths(spark, tables, monkeypatch):
    staged, stage = [], pipeline.stage
    monkeypatch.setattr(pipeline, "stage", lambda df, name: staged.append((name, derives(df))) or stage(df, name))
    queries.frequent_word_paths(spark, tables)
    assert [name for name, derived in staged if derived] == ["records"]


def test_text_records(spark, tables):
    rows = queries.legacy_text_records(spark, tables)
    assert not derives(rows)
    assert {r["kind"] for r in rows.collect()} >= {"path", "label", "size", "reject"}


def test_merged_corpora(spark, tables, monkeypatch):
    written, text = [], DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, path: written.append(path) or text(self, path))
    merged = sorted(map(tuple, queries.merged_corpora(spark, tables).collect()))
    assert len(written) == 1
    assert merged == sorted(map(tuple, queries.path_support(spark, tables).collect())) != []


def test_several_formats(lines):
    arcs = parse_arcs(lines(["a\ta/NN/x/0 b/IN/y/1 c/NNS/z/2", "d\td/NN/x/0 e/NN/y/1 f/NN/z/2 d/NN/w/3", "g\tg/NN/x/0"]))
    formats = ["word_pos_label", "pos", "word_label"]
    got = path_records(arcs, formats=formats).select("_format", "line_id", "dp", "a", "b")
    want = [
        (f, *r)
        for f in formats
        for r in path_records(arcs, Options(path_format=f)).select("line_id", "dp", "a", "b").collect()
    ]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 9

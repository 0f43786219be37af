import glob

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE_ARCS, SAMPLE_LABELS
from pathfeat import COMPATIBLE, FeaturePlan, Options, run
from pathfeat.operators import features
from pathfeat.operators.vocabulary import max_by_key, path_cells, path_support
from pathfeat.sources import arff, legacy
from pathfeat.sources.text import read_arcs, read_labels, read_tsv, write_tsv


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize(
    "dpmin, vocabulary, vectors",
    [
        (
            1,
            [("NN-JJ-NN", 0), ("NN-NN", 1), ("NN-VB-NN", 2)],
            [("chair", "furnitur", [1, 0, 1], True), ("sofa", "furnitur", [1, 0, 0], True)],
        ),
        (
            2,
            [("NN-JJ-NN", 0)],
            [("chair", "furnitur", [1], True), ("sofa", "furnitur", [1], True)],
        ),
        (3, [], []),
    ],
)
def test_sample_vectors(sample, dpmin, vocabulary, vectors):
    plan = FeaturePlan(*sample, Options(dpmin=dpmin))
    assert rows(plan.vocabulary, "dp", "id") == vocabulary
    assert plan.size.first()["vec_size"] == len(vocabulary)
    assert rows(plan.vectors, "a", "b", "features", "label") == vectors
    without = rows(plan.without_evidence, "a", "b", "label")
    assert ("chair", "aircraft", False) in without
    assert len(without) == 3 - len(vectors)
    assert plan.dense_cells.count() == 3 * len(vocabulary)


def test_compatible_options_on_the_sample(sample):
    plan = FeaturePlan(*sample, COMPATIBLE.but(dpmin=1))
    assert rows(plan.vectors, "a", "b", "features") == [
        ("chair", "furnitur", [1, 0, 1]),
        ("sofa", "furnitur", [1, 0, 0]),
    ]


def arcs_of(lines, values):
    from pathfeat.operators.parse import parse_arcs

    return parse_arcs(lines(values))


def labels_of(spark, values):
    return spark.createDataFrame(values, "w1 string, w2 string, label boolean")


def test_both_orders_share_their_evidence(spark, lines):
    arcs = arcs_of(lines, ["dog\tdog/NN/x/0 cat/NN/y/1", "cat\tcat/NN/x/0 as/IN/p/1 dog/NN/y/2"])
    labels = labels_of(spark, [("dog", "cat", True), ("cat", "dog", False), ("dog", "dog", True)])
    both = FeaturePlan(arcs, labels, Options(dpmin=1))
    assert rows(both.vectors, "a", "b", "features") == [("cat", "dog", [1, 1]), ("dog", "cat", [1, 1])]
    one = FeaturePlan(arcs, labels, Options(dpmin=1, symmetric=False))
    assert rows(one.vectors, "a", "b", "features") == [("cat", "dog", [0, 1]), ("dog", "cat", [1, 0])]


def test_conflicting_labels(spark, sample):
    labels = labels_of(spark, [("dogs", "cat", True), ("dog", "cats", False), ("a", "b", False)])
    any_true = FeaturePlan(sample[0], labels, Options(dpmin=1))
    assert rows(any_true.pairs, "a", "b", "label") == [("a", "b", False), ("dog", "cat", True)]
    dropped = FeaturePlan(sample[0], labels, Options(dpmin=1, label_rule="drop_conflicts"))
    assert rows(dropped.pairs, "a", "b", "label") == [("a", "b", False)]


def test_option_values():
    for bad in ({"dpmin": 0}, {"path_format": "x"}, {"pair_scope": "x"}, {"unrolled_hops": 0}):
        with pytest.raises(ValueError):
            Options(**bad)


def test_counts_add_up_and_dpmin_is_monotone(spark, lines):
    from test_paths import random_lines

    text = [
        f"{h}\t" + " ".join("/".join(map(str, t)) for t in toks) for h, toks in random_lines(5, 400)
    ]
    arcs = arcs_of(lines, text)
    words = ["dog", "cat", "run", "as", "thing"]
    labels = labels_of(spark, [(x, y, x < y) for x in words for y in words])
    previous = None
    for dpmin in (1, 2, 4):
        plan = FeaturePlan(arcs, labels, Options(dpmin=dpmin))
        ids = sorted(r["id"] for r in plan.vocabulary.collect())
        assert ids == list(range(len(ids)))
        kept = {r["dp"] for r in plan.vocabulary.collect()}
        assert previous is None or kept <= previous
        previous = kept
        flipped = plan.numbered_pairs.join(plan.pairs, ["a", "b"], "left_semi").count()
        assert plan.found.agg(F.sum("n")).first()[0] == flipped
        vectors = {(r["a"], r["b"]): r["features"] for r in plan.vectors.collect()}
        assert all(vectors[b, a] == v for (a, b), v in vectors.items() if (b, a) in vectors)


def test_a_path_with_most_records(spark):
    """One path and one pair hold most of the records."""
    records = spark.range(30000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 7)).alias("dp"),
        F.when(F.col("id") % 3 < 2, F.lit("a")).otherwise(F.concat(F.lit("a"), F.col("id") % 50)).alias("a"),
        F.lit("b").alias("b"),
    )
    support = path_support(path_cells(records))
    want = records.groupBy("dp").agg(
        F.countDistinct("a", "b").alias("n_pairs"), F.count("*").alias("n_records")
    )
    assert rows(support, "dp", "n_pairs", "n_records") == rows(want, "dp", "n_pairs", "n_records")


def test_max_by_key_starts_at_zero(spark):
    df = spark.createDataFrame([("x", -5), ("x", -1), ("y", 3), ("y", 9)], "k string, v bigint")
    assert rows(max_by_key(df, "k", "v"), "k", "v") == [("x", 0), ("y", 9)]


def test_dense_array(spark):
    cells = F.from_json(F.col("c"), "array<struct<id:bigint,n:bigint>>")
    df = spark.createDataFrame(
        [('[{"id":0,"n":2},{"id":3,"n":1}]',), ("[]",), ('[{"id":4,"n":7}]',)], "c string"
    ).select(features.dense_array(cells, F.lit(5)).alias("f"))
    assert [r["f"] for r in df.collect()] == [[2, 0, 0, 1, 0], [0] * 5, [0, 0, 0, 0, 7]]


def test_run_writes_everything(spark, tmp_path):
    # Several inputs for one corpus, the classifier left out: two vectors cannot be folded.
    for i, part in enumerate((SAMPLE_ARCS[:2], SAMPLE_ARCS[2:] + ["bad"])):
        (tmp_path / f"arcs{i}.txt").write_text("\n".join(part))
    (tmp_path / "labels.txt").write_text("\n".join([*SAMPLE_LABELS, "only two"]))
    out = str(tmp_path / "out")
    run(
        spark,
        [str(tmp_path / "arcs0.txt"), str(tmp_path / "arcs1.txt")],
        str(tmp_path / "labels.txt"),
        out,
        Options(dpmin=1),
        classifier=None,
        write_records=True,
        text_copies=True,
    )
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    assert read("frequent_paths").count() == 3
    assert read("kept_records").count() == 4
    assert read("numbered_pairs").count() == 8
    assert rows(read("rejected_lines"), "value", "reason") == [("bad", "no tokens")]
    assert rows(read("rejected_labels"), "value", "reason") == [("only two", "field count")]
    assert rows(spark.read.text(f"{out}/vector_size_tsv"), "value") == [("vec_size\t3",)]
    assert ("NN-NN\t1",) in rows(spark.read.text(f"{out}/vocabulary_tsv"), "value")
    parts = sorted(glob.glob(f"{out}/arff/*/part-*"))
    document = "".join(open(p).read() for p in parts)
    assert document == (
        "@RELATION vectors\n@ATTRIBUTE col0 NUMERIC\n@ATTRIBUTE col1 NUMERIC\n"
        "@ATTRIBUTE col2 NUMERIC\n@ATTRIBUTE class {True, False}\n@DATA\n"
        "%1\tchair\tfurnitur\n1,0,1,True\n%2\tsofa\tfurnitur\n1,0,0,True\n"
    )
    assert rows(arff.read_arff(spark, f"{out}/arff"), "features", "label") == [
        ([1, 0, 0], True), ([1, 0, 1], True),
    ]
    assert rows(arff.read_arff_pairs(spark, f"{out}/arff"), "num", "a", "b", "features") == [
        (1, "chair", "furnitur", [1, 0, 1]), (2, "sofa", "furnitur", [1, 0, 0]),
    ]


def test_run_with_a_classifier(spark, tmp_path):
    from test_paths import random_lines

    text = [
        f"{h}\t" + " ".join("/".join(map(str, t)) for t in toks) for h, toks in random_lines(9, 200)
    ]
    (tmp_path / "arcs.txt").write_text("\n".join(text))
    words = ["dogs", "cats", "run", "as", "NNx", "things"]
    pairs = [f"{x} {y} {str(x < y).lower()}" for x in words for y in words if x != y]
    (tmp_path / "labels.txt").write_text("\n".join(pairs))
    out = str(tmp_path / "out")
    plan = run(
        spark, str(tmp_path / "arcs.txt"), str(tmp_path / "labels.txt"), out, Options(dpmin=2),
        classifier="naive_bayes", folds=3,
    )
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    vectors = read("vectors").count()
    assert vectors > 20
    assert read("predictions").count() == vectors == read("summary").first()["n"]
    assert read("class_details").count() == 2
    assert read("samples").count() > 0
    assert arff.read_arff_pairs(spark, f"{out}/arff").count() == vectors
    assert plan.size.first()["vec_size"] == read("vector_size").first()["vec_size"]


def test_text_sources_and_sinks(spark, tmp_path):
    (tmp_path / "corpus").mkdir()
    (tmp_path / "corpus" / "a").write_text(SAMPLE_ARCS[0] + "\n")
    (tmp_path / "corpus" / "b").write_text(SAMPLE_ARCS[2] + "\n\n")
    arcs = read_arcs(spark, str(tmp_path / "corpus"))
    assert arcs.count() == 2
    assert arcs.select("line_id").distinct().count() == 2
    (tmp_path / "labels").write_text("dog animal True\n")
    labels = read_labels(spark, str(tmp_path / "labels"))
    assert rows(labels, "w1", "w2", "label") == [("dog", "animal", True)]
    write_tsv(labels, str(tmp_path / "tsv"))
    assert rows(spark.read.text(str(tmp_path / "tsv")), "value") == [("dog\tanimal\ttrue",)]


def test_tsv_keeps_empty_fields(spark, tmp_path):
    schema = "a string, b string, id bigint, n bigint"
    data = [("a", "b", None, 7), ("c", None, 1, None), (None, None, None, None), ("d", "e", 2, 3)]
    df = spark.createDataFrame(data, schema)
    write_tsv(df, str(tmp_path / "tsv"))
    assert ("a\tb\t\t7",) in rows(spark.read.text(str(tmp_path / "tsv")), "value")
    got = read_tsv(spark, str(tmp_path / "tsv"), schema).collect()
    assert sorted(map(tuple, got), key=str) == sorted(data, key=str)


def test_legacy_records(spark):
    lines = [
        "vec_size\t12",
        "NN-VB-NN\t3",
        "dog\tanimal\tTrue",
        "dog\tanimal\t03,7",
        "dog\tanimal\t1,0,3,true",
        "dog\tanimal\t3:NN-VB-NN:animal\tanimal/NN/a/0 like/VB/x/1 dog/NN/p/2",
        "NN-VB-NN\tdog\tanimal:animal\tanimal/NN/a/0 like/VB/x/1 dog/NN/p/2",
        "junk",
        "dog\tanimal\tjunk",
        "dog\tanimal\tjunk more",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [tuple(r) for r in legacy.route_records(df).collect()]
    line = "animal\tanimal/NN/a/0 like/VB/x/1 dog/NN/p/2"
    nothing = (None,) * 3
    assert got == [
        ("size", None, None, None, None, None, 12, *nothing),
        ("vocabulary", None, None, None, 3, "NN-VB-NN", None, *nothing),
        ("label", "dog", "animal", True, None, None, None, *nothing),
        ("cell", "dog", "animal", None, 3, None, 7, *nothing),
        ("vector", "dog", "animal", True, None, None, None, "1,0,3", None, None),
        ("numbered", "dog", "animal", None, 3, "NN-VB-NN", None, None, line, None),
        ("path", "dog", "animal", None, None, "NN-VB-NN", None, None, line, None),
        ("reject", *(None,) * 7, "junk", "field count"),
        ("reject", *(None,) * 7, "dog\tanimal\tjunk", "third field"),
        ("reject", *(None,) * 7, "dog\tanimal\tjunk more", "neither an id nor a word before a colon"),
    ]


def test_index_padding(spark):
    from pathfeat.functions import lpad_index

    df = spark.createDataFrame([(0, 10), (9, 10), (0, 9), (123, 1000)], "i int, n int")
    got = [r[0] for r in df.select(lpad_index(F.col("i"), F.col("n"))).collect()]
    assert got == ["00", "09", "0", "0123"]

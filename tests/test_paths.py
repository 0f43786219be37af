import random

import pytest
from pyspark.sql import functions as F

from pathfeat import Options
from pathfeat.operators.graph import head_graph, noun_pairs
from pathfeat.operators.parse import parse_arcs
from pathfeat.operators.paths import path_records, walk_up
from pathfeat.operators.stemming import stem_arcs


def found(df):
    return sorted(tuple(r) for r in df.select("line_id", "dp", "a", "b").collect())


def test_sample(sample):
    assert found(path_records(sample[0])) == [
        (1, "NN-VB-NN", "chair", "furnitur"),
        (3, "NN-JJ-NN", "chair", "furnitur"),
        (3, "NN-JJ-NN", "sofa", "furnitur"),
        (4, "NN-NN", "dramat", "abl"),
    ]


def test_formats(sample):
    def line3(path_format):
        records = found(path_records(sample[0], Options(path_format=path_format)))
        return [r[1] for r in records if r[0] == 3 and r[2] == "sofa"]

    assert line3("word_pos_label") == ["X/NN/advmod-as/JJ/prep-X/NN/acomp"]
    assert line3("word_label") == ["X/advmod-as/prep-X/acomp"]


# A line of the published corpus format.
LOOPING = "abound\tabound/NN/attr/0 in/IN/prep/1 countri/NNS/pobj/2 in/IN/prep/3 world/NN/pobj/4"


@pytest.mark.parametrize("hops", [1, 2, 5])
def test_repeated_word_on_the_way(lines, hops):
    arcs = parse_arcs(lines([LOOPING]))
    assert found(path_records(arcs, Options(unrolled_hops=hops))) == [
        (1, "NN-IN-NNS", "world", "countri"),
        (1, "NN-IN-NNS-IN-NN", "world", "abound"),
        (1, "NNS-IN-NN", "countri", "abound"),
    ]


@pytest.mark.parametrize("hops", [1, 3, 6])
def test_cycles_end(lines, hops):
    arcs = parse_arcs(
        lines(
            [
                # b and c point at each other; d enters the cycle and meets each once.
                "a\ta/NN/x/0 b/NN/x/3 c/NN/x/2 d/NN/x/2",
                # A cycle without the target.
                "a\ta/NN/x/0 b/VB/x/3 c/VB/x/2 d/NN/x/2",
            ]
        )
    )
    assert found(path_records(arcs, Options(unrolled_hops=hops))) == [
        (1, "NN-NN", "b", "c"),
        (1, "NN-NN", "c", "b"),
        (1, "NN-NN", "d", "b"),
        (1, "NN-NN-NN", "d", "c"),
    ]


def test_equal_tokens_are_one_node(lines):
    # dogs and dog are one node once stemmed, so the path from cat reaches it once
    # and the second copy starts no walk of its own.
    arcs = parse_arcs(lines(["run\trun/NN/r/0 dogs/NN/x/1 dog/NN/x/1 cat/NN/y/3"]))
    assert found(path_records(arcs)) == [
        (1, "NN-NN", "cat", "dog"),
        (1, "NN-NN", "dog", "run"),
        (1, "NN-NN-NN", "cat", "run"),
    ]


def test_head_and_noun_rules(lines):
    arcs = parse_arcs(lines(["dogs\tdogs/NN/r/0 CNN/VB/x/1", "dogs\tdogs/VB/r/0 cats/NN/x/1"]))
    stemmed = {r["line_id"]: (r["head"], [t["word"] for t in r["toks"]]) for r in stem_arcs(arcs).collect()}
    assert stemmed == {1: ("dog", ["dog", "CNN"]), 2: ("dogs", ["dogs", "cat"])}
    assert found(path_records(arcs)) == [(1, "VB-NN", "CNN", "dog")]
    assert found(path_records(arcs, Options(noun_on="pos"))) == []


def test_stem_scope(lines):
    arcs = parse_arcs(lines(["a\ta/NN/x/0 datives/NN/datives/1"]))
    labels = lambda o: [t["label"] for t in stem_arcs(arcs, o).first()["toks"]]
    assert labels(Options()) == ["x", "datives"]
    assert labels(Options(stem_scope="descriptor")) == ["x", "dativ"]


def test_first_half_scope(lines):
    arcs = parse_arcs(lines(["a\ta/NN/x/0 b/NN/x/1 c/NN/x/2 d/NN/x/3"]))
    everything = found(path_records(arcs))
    first_half = found(path_records(arcs, Options(pair_scope="first_half")))
    assert len(everything) == 6
    assert set(everything) - set(first_half) == {(1, "NN-NN", "d", "c")}


def random_lines(seed, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        size = rng.randint(1, 9)
        toks = []
        for k in range(size):
            word = rng.choice(["dog", "dogs", "cat", "cats", "run", "as", "NNx", "thing"])
            pos = rng.choice(["NN", "NNS", "VB", "IN"])
            toks.append((word, pos, rng.choice(["x", "y"]), rng.randint(0, size)))
        head = rng.choice(["dog", "dogs", "cat", toks[0][0]])
        rows.append((head, toks))
    return rows


def brute_force(head, toks, first_half=False):
    """Path records of one line, pair by pair over a map of descriptors."""
    from test_stemmer import brute_force as stem

    is_noun = lambda t: any("NN" in str(f) for f in t[:3])
    new_head = stem(head) if any(is_noun(t) and t[0] == head and t[3] == 0 for t in toks) else head
    toks = [(stem(t[0]),) + t[1:] if is_noun(t) else t for t in toks]
    root = next((t for t in toks if t[0] == new_head and t[3] == 0), None)
    parent = {t: (toks[t[3] - 1] if t[3] else root) for t in toks}
    nouns = [t for t in toks if is_noun(t)]
    pairs = set()
    for i, x in enumerate(nouns):
        for y in nouns[i + 1 :]:
            if x[0] != y[0] and (not first_half or i < (len(nouns) + 1) // 2):
                pairs |= {(x, y), (y, x)}
    out = []
    for x, y in pairs:
        node, path, seen = x, [x[1]], {x}
        while True:
            node = parent[node]
            if node is None or node in seen:
                break
            seen.add(node)
            path.append(node[1])
            if node == y:
                out.append(("-".join(path), x[0], y[0]))
                break
    return out, pairs


@pytest.mark.parametrize("scope", ["all", "first_half"])
@pytest.mark.parametrize("hops", [1, 5])
def test_random_lines(lines, scope, hops):
    rows = random_lines(11, 1500)
    text = [f"{h}\t" + " ".join("/".join(map(str, t)) for t in toks) for h, toks in rows]
    options = Options(pair_scope=scope, unrolled_hops=hops)
    want = sorted(
        (i, *record)
        for i, (h, toks) in enumerate(rows, 1)
        for record in brute_force(h, toks, scope == "first_half")[0]
    )
    assert found(path_records(parse_arcs(lines(text)), options)) == want


def test_noun_pairs_cover_the_walk(lines):
    rows = random_lines(3, 300)
    text = [f"{h}\t" + " ".join("/".join(map(str, t)) for t in toks) for h, toks in rows]
    stemmed = stem_arcs(parse_arcs(lines(text)))
    pairs = {tuple(r) for r in noun_pairs(stemmed).select("line_id", "a", "b").collect()}
    walked = {tuple(r) for r in walk_up(stemmed).select("line_id", "a", "b").collect()}
    want = {
        (i, x[0], y[0])
        for i, (h, toks) in enumerate(rows, 1)
        for x, y in brute_force(h, toks)[1]
    }
    assert pairs == want
    assert walked <= pairs


def test_head_graph(sample):
    rows = head_graph(stem_arcs(sample[0])).where("line_id = 1").orderBy("k").collect()
    # The head is no pointer-0 token: the root has no parent.
    assert [(r["k"], r["node"], r["parent"]) for r in rows] == [(1, 1, 0), (2, 2, 1), (3, 3, 2)]


def test_repartitioning_changes_nothing(sample):
    assert found(path_records(sample[0].repartition(7))) == found(path_records(sample[0]))


def test_carried_columns_may_have_any_name(sample):
    arcs = sample[0].withColumn("hit", F.lit(1)).withColumn("start", F.lit(2)).withColumn("nodes", F.lit(3))
    assert {(r["hit"], r["start"], r["nodes"]) for r in path_records(arcs).collect()} == {(1, 2, 3)}


def test_the_long_corpus_reaches_every_branch(spark):
    from pathfeat import Options
    from workload import corpus
    from workload.queries import head_graph_long, path_records_long, reject_arcs_long

    sf_dir = "/root/testdata/sf0.001"
    reasons = {r["reason"] for r in reject_arcs_long(spark, sf_dir).select("reason").distinct().collect()}
    assert reasons == {"empty head", "no tokens", "token arity", "special character", "pointer"}
    hops = path_records_long(spark, sf_dir).selectExpr("size(split(dp, '-')) - 1 AS n")
    assert hops.agg({"n": "max"}).first()[0] > Options().unrolled_hops
    nodes = head_graph_long(spark, sf_dir)
    assert nodes.where("parent = 0").count() > 0  # no root, or the root itself
    # Two nodes that are each other's parent are a cycle.
    other = nodes.selectExpr("doc_id", "line_no", "node AS parent", "parent AS node")
    assert nodes.join(other, ["doc_id", "line_no", "node", "parent"], "left_semi").where("node <> parent").count() > 0
    assert corpus.long_arcs(spark, sf_dir).selectExpr("max(size(toks))").first()[0] == corpus.LONG


@pytest.mark.parametrize("scope", ["all", "first_half"])
def test_lines_are_stemmed_once_for_noun_pairs(sample, scope):
    pairs = noun_pairs(stem_arcs(sample[0]), Options(pair_scope=scope))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan

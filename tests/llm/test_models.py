import random

import numpy as np
import pyarrow as pa
import pytest
from cases import AWKWARD
from pyspark.sql import functions as F

from pathfeat.llm import quality, toxicity
from pathfeat.llm.sampling import Sample, fit_logistic, labelled_sample

INSULTS = ["vexlark", "vexlorn", "grubnik"]


def corpus(kind):
    rnd = random.Random(6)
    vocabulary = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9))) for _ in range(400)]
    docs, labels = [], []
    for i in range(900):
        w = rnd.choices(vocabulary, k=rnd.randint(20, 120))
        bad = i % 5 == 0
        if bad and kind == "toxic":
            for _ in range(4):
                w.insert(rnd.randint(0, len(w)), rnd.choice(INSULTS) + rnd.choice(["", "a", "ed"]))
        if bad and kind == "quality":
            w = [x.upper() + "!!" for x in w] if i % 2 else [x for x in w[:20] for _ in range(4)]
        docs.append((i, " ".join(w)))
        if i % 3:
            labels.append((i, int(not bad), int(bad)))
    return docs, labels


def tables(spark, kind):
    docs, labels = corpus(kind)
    rows = docs + [(None if k is None else 5000 + k, t) for k, t in AWKWARD]
    d = spark.createDataFrame([(*r, 0.5, 1) for r in rows], "doc_id bigint, text string, score double, label int")
    labels = labels + [(None, 1, 1), (7, None, None), (1, *labels[0][1:])]
    return d.repartition(3), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("kind", ["toxic", "quality"])
def test_held_out_accuracy(spark, empty, kind):
    docs, labels = tables(spark, kind)
    module, score = {"toxic": (toxicity, toxicity.toxicity), "quality": (quality, quality.quality)}[kind]
    model = module.fit(docs, labels, F.col("key") % 4 != 0, per_class=400)
    rows = score(docs, model).collect()
    assert len(rows) == 900 + len(AWKWARD)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [(r.score, r.row.doc_id % 5 == 0) for r in rows if r.row.doc_id is not None and r.row.doc_id < 900 and (r.row.doc_id % 4 == 0 or r.row.doc_id % 3 == 0)]
    right = [(s >= 0.5) == (bad if kind == "toxic" else not bad) for s, bad in held]
    assert np.mean(right) > 0.97
    assert score(empty, model).collect() == []
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    flat = score(docs, module.fit(docs, none, F.lit(True))).collect()
    assert {r.score for r in flat} == {0.0 if kind == "toxic" else 0.5}
    one = module.fit(docs, labels.where("toxic = 0 and quality = 1"), F.lit(True))
    want = 0.0 if kind == "toxic" else 1.0
    assert all(r.score == pytest.approx(want) for r in score(docs, one).collect())


def test_neighbours_are_exact(spark):
    docs, labels = tables(spark, "toxic")
    model = toxicity.fit(docs, labels, F.lit(True), per_class=300, least_gain=2.0)
    index = model.index
    n, width = len(index.ids), len(index.idf) + 1
    texts = dict(corpus("toxic")[0])
    rows, terms, counts = model.vocabulary.counts(pa.array([texts[i] for i in index.ids.tolist()]))
    weight, rest = index.unit(rows, terms, counts, n)
    dense = np.zeros((n, width))
    dense[rows, terms], dense[:, -1] = weight, rest
    assert np.allclose(np.linalg.norm(dense, axis=1), 1)
    for q in range(0, n, 5):
        own = np.flatnonzero(dense[q])
        best, cosine = index.nearest(own, dense[q, own], 9, leave=q)
        scores = np.round(dense @ dense[q], 12)
        order = [i for i in np.lexsort([index.ids, -scores]) if i != q][:9]
        assert np.allclose(cosine, scores[order], atol=1e-9)
        if len(set(scores[order])) == 9:
            assert best.tolist() == order


def test_sample(spark):
    docs, labels = tables(spark, "toxic")
    sample = labelled_sample(docs, labels, "toxic", F.col("key") % 4 != 0, 50)
    assert sorted(np.bincount(sample.labels)) == [50, 50]
    assert all(i % 4 for i in sample.ids)
    known = [r for r in corpus("toxic")[1] if r[0] % 4]
    total = [sum(1 for r in known if r[2] == v) for v in (0, 1)]
    for v in (0, 1):
        assert sample.weights[sample.labels == v].sum() == pytest.approx(total[v])


def test_logistic():
    rnd = np.random.default_rng(1)
    x = rnd.uniform(0, 1, 4000)
    y = (rnd.uniform(0, 1, 4000) < 1 / (1 + np.exp(-(6 * x - 3)))).astype(float)
    slope, constant = fit_logistic(x, y, np.ones(4000), ridge=1e-6)
    assert abs(slope - 6) < 0.6 and abs(constant + 3) < 0.4


def test_copy_of_a_rare_example_finds_it(spark):
    docs, labels = corpus("toxic")
    rnd = random.Random(9)
    rare = " ".join("".join(rnd.choices("klmnopq", k=7)) for _ in range(40))
    docs = [*docs, (9000, rare), (9001, rare)]
    labels = [*labels, (9000, 0, 1)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    model = toxicity.fit(
        d, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), F.lit(True)
    )
    (found,) = toxicity.toxicity(d.where("doc_id = 9001"), model).collect()
    assert found.neighbours[0] == 9000 and found.cosines[0] == pytest.approx(1)
    assert found.score >= 0.7


def _sample(rows):
    ids, texts, labels = zip(*rows)
    return Sample([*ids], [*texts], np.array(labels), np.arange(1.0, len(rows) + 1))


def test_unrelated_texts_are_no_copies():
    rnd = np.random.default_rng(3)
    share = 1 / np.arange(1, 2001)
    rows = []
    for i in range(300):
        words = rnd.choice(2000, 400, p=share / share.sum())
        rows.append((i, " ".join(f"w{'abcdefghij'[w % 10]}{np.base_repr(w, 26).translate(LETTERS)}" for w in words), i % 2))
    kept, weights = toxicity._first_of_copies(_sample(rows))
    assert kept.tolist() == [*range(300)] and weights.tolist() == [*range(1, 301)]


LETTERS = str.maketrans("0123456789ABCDEFGHIJKLMNOPQ", "zabcdefghijklmnopqrstuvwxyy")


def test_near_copies_of_one_label_count_once():
    rnd = random.Random(4)
    words = ["".join(rnd.choices("abcdefgh", k=6)) for _ in range(100)]
    text, other = " ".join(words), " ".join(words[::-1])
    rows = [
        (1, text, 0),
        (2, text, 0),
        (3, f"vexlark {text}", 1),  # the clean text but for an insult
        (4, f"{text} grubnik", 0),
        (5, " ".join([*words[:80], *words[:20]]), 0),  # 76 of 100 shingles, below 4/5
        (6, other, 0),
        (7, "", 0),
        (8, "", 0),
        (9, "vexlark", 1),
        (10, "vexlark you", 1),
    ]
    kept, weights = toxicity._first_of_copies(_sample(rows))
    assert [rows[i][0] for i in kept] == [1, 3, 5, 6, 7, 9, 10]
    assert weights.tolist() == [1 + 2 + 4, 3, 5, 6, 7 + 8, 9, 10]
    assert weights.sum() == sum(range(1, 11))


def test_copies_by_brute_force():
    rnd = random.Random(8)
    base = [["".join(rnd.choices("abcdef", k=5)) for _ in range(60)] for _ in range(6)]
    rows = []
    for i in range(150):
        words = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(60)] = "new" + rnd.choice("abcdefgh")
        rows.append((i, " ".join(words), rnd.randint(0, 1)))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(56)} for _, t, _ in rows]
    want = []
    for i, (_, text, label) in enumerate(rows):
        same = [j for j in want if rows[j][2] == label]
        if not any(5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in same):
            want.append(i)
    kept, weights = toxicity._first_of_copies(_sample(rows))
    assert kept.tolist() == want and weights.sum() == sum(range(1, 151))


def test_sample_takes_one_row_of_an_id(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int")
    sizes, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: (rows := collect(df), sizes.append(len(rows)))[0])
    sample = labelled_sample(docs, labels, "toxic", F.lit(True), 10)
    assert (sample.ids, sample.texts) == ([1, 2], ["text 99", ""]) and max(sizes) == 2

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pathfeat.llm.collocations import SCALE, collocations

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute_force(rows, least, most, covered=(50, 100)):
    counts = {}
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for size in (1, 2, 3):
                own.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = set()
        for p, a in frequent.items():
            if len(p) == 3:
                dropped |= {q for q in (p[:2], p[1:]) if q in frequent and covered[1] * a >= covered[0] * frequent[q]}
        scored = []
        for p, a in frequent.items():
            if p in dropped:
                continue
            cuts = [(SCALE * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return sorted(out)


def _texts(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["É", "ABC", "abc", "漢", "x y", "\U0001f600"]
    weights = [1 / (i + 1) for i in range(len(words))]
    fixed = ["new york city", "w1 w2 w3", "hot dog", "Rare Pair here"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 30)):
            parts.append(rng.choice(fixed) if rng.random() < 0.2 else rng.choices(words, weights)[0])
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]))
        rows.append((rng.choice(["en", "en", "en", "de", None]), "".join(parts)))
    return [*rows, ("en", None), ("en", ""), ("xx", "  ., "), ("yy", "one two three")]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").repartition(5)


@pytest.mark.parametrize("start, limit", [(None, 1 << 24), (1, 1 << 24), (3, 0), (None, 0)])
def test_brute_force(spark, start, limit):
    rows = _texts(3)
    want = brute_force(rows, 4, 7)
    found = collocations(_frame(spark, rows), least=4, most=7, start=start, broadcast_bytes=limit)
    assert sorted(map(tuple, found.select(COLUMNS).collect())) == want
    assert len(want) > 14


def test_all_phrases_and_repeated_rows(spark):
    rows = _texts(5) * 2
    found = collocations(_frame(spark, rows), least=2, most=10_000)
    assert sorted(map(tuple, found.select(COLUMNS).collect())) == brute_force(rows, 2, 10_000)


def test_ties_at_the_last_rank_and_a_hot_phrase(spark):
    pairs = [("en", f"l{i:02} r{i:02}. ") for i in range(40)] * 5 + [("en", "hot pair " * 3000)]
    found = collocations(_frame(spark, pairs), least=5, most=10, start=1).orderBy("rank")
    assert list(map(tuple, found.select(COLUMNS).collect())) == brute_force(pairs, 5, 10)


def test_awkward_tables(spark, awkward, empty):
    plain = awkward.withColumn("lang", F.lit(None).cast("string")).withColumn("rank", F.lit(1))
    texts = [(None, r.text) for r in plain.collect()]
    found = collocations(plain, least=2, most=50).select(COLUMNS)
    assert sorted(map(tuple, found.collect())) == brute_force(texts, 2, 50)
    assert collocations(empty.withColumn("lang", F.lit("en"))).count() == 0
    none = collocations(_frame(spark, [("en", None), (None, "")]))
    assert none.count() == 0


def test_staged_tables_go(spark, tmp_path):
    from pathfeat.plans.staging import Staging

    with Staging(str(tmp_path)) as scope:
        found = collocations(_frame(spark, _texts(3)), least=4, most=7)
        left = [p.name.split("-")[0] for p in (tmp_path / "pathfeat").iterdir()]
        assert left == ["collocations"] and found.count()
    scope.close()
    assert not list((tmp_path / "pathfeat").iterdir())

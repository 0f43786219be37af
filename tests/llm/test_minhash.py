import random
import re

import numpy as np
import pyarrow as pa
import pytest
from cases import AWKWARD

from pathfeat.llm.columns import text_bytes
from pathfeat.llm.components import components
from pathfeat.llm.minhash import least_matches, near_duplicates, shingle_sets, signatures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)) if w)


def brute(rows):
    """Per distinct (id, text): set size and component, links by exact similarity."""
    sets = {}
    for key, text in rows:
        if key is not None:
            sets.setdefault(sets_of(text), []).append(key)
    names = [s for s in sets if s]
    root = {s: min(sets[s]) for s in names}
    up = {r: r for r in root.values()}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in enumerate(names):
        for t in names[:i]:
            shared = len(s & t)
            if 100 * shared >= 85 * (len(s) + len(t) - shared):
                a, b = find(root[s]), find(root[t])
                up[max(a, b)] = min(a, b)
    out = []
    for key, text in rows:
        s = sets_of(text)
        found = None if key is None else key if not s else find(root[s])
        out.append((key, len(s), found, key is None or key == found))
    return sorted(out, key=str)


def family(rnd, n, size, most):
    """Copies of a text with up to ``most`` words changed, many of them near the limit."""
    base = [f"w{rnd.randint(0, 10**6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rnd.randint(0, most)):
            own[rnd.randrange(size)] = f"v{rnd.randint(0, 10**6)}"
        out.append(" ".join(own))
    return out


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(8)
    texts = family(rnd, 60, 120, 6) + family(rnd, 30, 300, 14) + family(rnd, 20, 40, 2)
    texts += [" ".join(f"u{rnd.randint(0, 50)}" for _ in range(rnd.randint(1, 80))) for _ in range(80)]
    texts += ["The Same Text of all of these copies"] * 50 + ["the same  TEXT of all\tof these copies"] * 5
    texts += ["one two three", "One two THREE", "one two", "É two", "é two"]
    rnd.shuffle(texts)
    return [(10 + i, t) for i, t in enumerate(texts)] + [(k if k is None else 5000 + k, t) for k, t in AWKWARD]


@pytest.mark.parametrize("most_chunks", [32, 0])
def test_components(spark, rows, most_chunks):
    df = spark.createDataFrame([(*r, "r", 2) for r in rows], "doc_id bigint, text string, rep string, n int")
    got = near_duplicates(df.repartition(4), most_chunks=most_chunks)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_small_chunks(spark, rows, monkeypatch):
    from pathfeat.llm import minhash

    monkeypatch.setattr(minhash, "_CHUNK", 7)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, near_duplicates(df).collect()), key=str) == brute(rows)


def test_empty(empty):
    assert near_duplicates(empty).collect() == []


def test_graph(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 99), (99, 98), (200, 200)]
    edges += [(rnd.randint(300, 340), rnd.randint(300, 340)) for _ in range(25)]
    rnd.shuffle(edges)
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for start in sorted(near):
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = start
                todo += near[x]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.node: r.component for r in got.collect()} == want


def test_signatures_estimate_similarity():
    rnd = random.Random(3)
    texts = family(rnd, 40, 400, 20)
    sets, edge = shingle_sets(*text_bytes(pa.array(texts)))
    assert np.diff(edge).tolist() == [len(sets_of(t)) for t in texts]
    sig = signatures(sets, edge, 500)
    for i in range(1, 40):
        s, t = sets_of(texts[0]), sets_of(texts[i])
        assert abs((sig[0] == sig[i]).mean() - len(s & t) / len(s | t)) < 0.12


def test_limits_grow_with_the_miss_probability():
    strict, loose = (least_matches(25, 125, 0.85, m) for m in (1e-9, 1e-3))
    assert [n for n, _ in strict] == [25, 50, 75, 100, 125]
    assert all(a < b for (_, a), (_, b) in zip(strict, loose))
    assert strict[-1][1] < 0.85 * 125

import hashlib
import random
import re

import numpy as np
import pytest
from cases import AWKWARD
from hypothesis import given, settings
from hypothesis import strategies as st

from pathfeat.llm.decontaminate import contamination, decontaminated
from pathfeat.llm.fm_index import FMIndex, suffix_array

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    data = (text or "").encode()
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    return [m.group() for m in WORD.finditer(lower)], [m.span() for m in WORD.finditer(lower)]


def brute(docs, items, window, share):
    owners = {}
    for item, text in items:
        w = words(text)[0]
        for i in range(max(1, len(w) - window + 1) if w else 0):
            owners.setdefault(tuple(w[i : i + window]), set()).add(str(item))
    out = []
    for key, text in docs:
        w, spans = words(text)
        hit, found = set(), set()
        for n in {len(x) for x in owners}:
            for i in range(len(w) - n + 1):
                own = owners.get(tuple(w[i : i + n]))
                if own:
                    hit |= set(range(i, i + n))
                    found |= own
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        runs = [i for i in sorted(hit) if i - 1 not in hit]
        stops = [i for i in sorted(hit) if i + 1 not in hit]
        out.append(
            (key, len(w), len(hit), len(found), sha, len(hit) > 0 and share * len(hit) >= len(w))
            + ([spans[i][0] for i in runs], [spans[i][1] for i in stops])
        )
    return sorted(out, key=str)


COLUMNS = "doc_id n_words n_hit n_items items_sha256 contaminated span_starts span_ends".split()


def rows(df):
    return sorted([tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect()], key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 3), min_size=1, max_size=4))
def test_index_finds_every_occurrence(values, pattern):
    index = FMIndex(np.array(values, np.int64), 4, sample=3)
    lo, hi = index.search(np.array([pattern]), np.array([len(pattern)]))
    got = sorted(index.locate(np.arange(lo[0], hi[0])).tolist())
    n = len(pattern)
    assert got == [i for i in range(len(values) - n + 1) if values[i : i + n] == pattern]
    data = np.array([*values, -1])
    want = sorted(range(len(data)), key=lambda i: data[i:].tolist())
    assert suffix_array(data).tolist() == want


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(5)
    vocabulary = ["alpha", "Beta", "c3", "été", "x", "Y2K", "漢字"]
    text = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    items = [(i, text(rnd.choice([0, 1, 2, 5, 9]))) for i in range(9)]
    items += [(9, "one, two; three!"), (9, "one, two; three!"), (10, None), (11, "--- ...")]
    items += [(12, "ONE two three")]
    docs = [(100 + i, text(rnd.randint(0, 60))) for i in range(60)] + AWKWARD
    docs += [(200, "so One-TWO (three) four"), (201, "one two"), (202, "three one two three" * 900)]
    d = spark.createDataFrame([(*r, "e") for r in docs], "doc_id bigint, text string, items string")
    b = spark.createDataFrame([(*r, 3) for r in items], "item_id bigint, text string, doc_id int")
    return docs, items, d.repartition(5), b


@pytest.mark.parametrize("block_bytes", [1 << 24, 60])
def test_contamination(tables, block_bytes):
    docs, items, d, b = tables
    got = rows(contamination(d, b, window=4, share=3, block_bytes=block_bytes))
    assert got == brute(docs, items, 4, 3)


def test_spans_go_from_contaminated_texts(tables):
    docs, items, d, b = tables
    cut = decontaminated(d, b, window=4, share=3)
    assert cut.columns == d.columns
    got = sorted([(r.doc_id, r.text) for r in cut.collect()], key=str)
    assert got == sorted(brute_by_row(docs, items), key=str)


def brute_by_row(docs, items):
    out = []
    for key, text in docs:
        (row,) = brute([(key, text)], items, 4, 3)
        if row[5]:
            data, at, parts = text.encode(), 0, []
            for a, b in zip(row[6], row[7]):
                parts.append(data[at:a])
                at = b
            text = b"".join([*parts, data[at:]]).decode()
        out.append((key, text))
    return out


def test_empty_tables(spark, empty, tables):
    _, _, d, b = tables
    assert contamination(empty, b).collect() == []
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert all(r.n_hit == 0 and not r.contaminated for r in contamination(d, none).collect())


def test_repeated_items_are_collected_once(spark, tables, monkeypatch):
    docs, items, d, b = tables
    many = b.union(spark.createDataFrame([(3, "one two three four", 3)] * 400, b.schema))
    sizes, collect = [], type(b).collect
    monkeypatch.setattr(type(b), "collect", lambda df: (found := collect(df), sizes.append(len(found)))[0])
    contamination(d, many, window=4, share=3, block_bytes=60)
    assert 0 < max(sizes) < 20
    monkeypatch.undo()
    assert rows(contamination(d, many, window=4, share=3)) == brute(docs, [*items, (3, "one two three four")], 4, 3)

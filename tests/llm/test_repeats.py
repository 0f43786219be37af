import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from cases import AWKWARD
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pathfeat.llm import repeats
from pathfeat.llm.repeats import repeats_removed, without_repeats
from pathfeat.llm.suffixes import common_prefixes, sort_suffixes


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(min_size=3, max_size=30), min_size=1, max_size=6), st.integers(1, 3))
def test_two_stage_order(pieces, letters):
    pieces = [bytes(b % (letters + 1) for b in p) for p in pieces]
    text, depth = b"".join(pieces), 3
    ends = np.cumsum([len(p) for p in pieces])
    wanted = [e - len(p) + i for e, p in zip(ends, pieces) for i in range(len(p) - depth + 1)]
    data = np.frombuffer(text, np.uint8)
    order = sort_suffixes(data, ends, np.array(wanted, np.int64), depth)
    assert sorted(order.tolist()) == wanted
    prefixes = [text[i : i + depth] for i in order.tolist()]
    assert prefixes == sorted(prefixes)
    lcp = common_prefixes(data, order, depth).tolist()
    for i in range(1, len(order)):
        same = [x == y for x, y in zip(prefixes[i - 1], prefixes[i])]
        assert lcp[i] == (same + [False]).index(False)


def brute(rows, length):
    held = {}
    for key, text in rows:
        if key is not None:
            data = (text or "").encode()
            for i in range(len(data) - length + 1):
                s = data[i : i + length]
                held[s] = min(held.get(s, key), key)
    out = []
    for key, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        if key is not None:
            for i in range(len(data) - length + 1):
                if held[data[i : i + length]] < key:
                    gone[i : i + length] = b"\1" * length
        spans = [i for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1])]
        ends = [i + 1 for i in range(len(gone)) if gone[i] and (i + 1 == len(gone) or not gone[i + 1])]
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((key, len(data), sum(gone), len(spans), hashlib.sha256(kept).hexdigest(), spans, ends, kept))
    return out


def documents():
    rnd = random.Random(3)
    passages = ["".join(rnd.choices("abé \n", k=rnd.randint(10, 90))) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = ["".join(rnd.choices("abcdefgh ", k=rnd.randint(0, 60))) for _ in range(3)]
        rows.append((i, parts[0] + rnd.choice(passages) + parts[1] + rnd.choice(passages) + parts[2]))
    rows += [(200 + i, rows[5][1]) for i in range(40)]
    rows += [(300, "ab" * 400), (301, "x" + "ab" * 300), (302, "a" * 500), (303, "a" * 49 + "\0" * 60)]
    rows += [(304, "\0" * 55), (305, "é" * 60), (306, "x" + "é" * 40)]
    rows += [(400 + i if i is not None else None, t) for i, t in AWKWARD]
    return rows


OUTPUTS = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "span_starts", "span_ends")


def test_repeats(spark, empty):
    rows = documents()
    df = spark.createDataFrame([(*r, "g", 1) for r in rows], "doc_id bigint, text string, grp string, shard int")
    for group_bytes in (1 << 21, 700):
        got = repeats_removed(df.repartition(7), 50, group_bytes, outputs=OUTPUTS)
        got = [(r.row.doc_id, *[r[c] for c in OUTPUTS]) for r in got.collect()]
        want = [r[:7] for r in brute(rows, 50)]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert repeats_removed(empty, 50).collect() == []


def test_texts_are_cut(spark):
    rows = documents()
    df = spark.createDataFrame([(*r, None) for r in rows], "doc_id bigint, text string, kept string")
    got = without_repeats(df)
    assert got.columns == df.columns
    want = []
    for (key, text), r in zip(rows, brute(rows, 50)):
        left = r[7].decode(errors="ignore") if r[2] else text
        if not r[2] or left.strip(" "):
            want.append((key, left))
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted(want, key=str)


def test_crowded_keys_are_dealt_by_whole_strings(spark):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for most_runs in (0, 3, 40):
        got = repeats_removed(df.repartition(5), 50, 700, outputs=OUTPUTS, most_runs=most_runs)
        got = [(r.row.doc_id, *[r[c] for c in OUTPUTS]) for r in got.collect()]
        assert sorted(got, key=str) == sorted([r[:7] for r in brute(rows, 50)], key=str)


def test_a_common_phrase_spreads_over_shards():
    rnd = random.Random(5)
    phrase = "all of these words stand in every page "
    texts = [
        "".join(rnd.choices("abcdefgh", k=60)) + phrase + "".join(rnd.choices("abcdefgh", k=60))
        for _ in range(600)
    ]
    tables = [
        pa.table({"grp": [g] * 200, "key": [*range(g, 600, 3)], "text": texts[g::3]}) for g in range(3)
    ]
    keys = pa.concat_tables([repeats._key_sender(50, 32)(t) for t in tables])
    answer = repeats._answer(100)
    shards = sorted(set(keys.column("shard").to_pylist()))
    answers = pa.concat_tables([answer(keys.filter(pc.equal(keys["shard"], s))) for s in shards])
    runs = {}
    for g, table in enumerate(tables):
        sent = repeats._run_sender(50, 32)(table, answers.filter(pc.equal(answers["grp"], g)))
        for r in sent.to_pylist():
            first = repeats._unpacked(r["payload"], r["size"], [np.int64, *[np.int32] * 3])[0]
            runs[r["shard"]] = runs.get(r["shard"], 0) + len(first)
    assert max(runs.values()) < sum(runs.values()) / 8


def test_rows_without_an_id_stay_where_they_are(spark):
    df = spark.range(1000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("x" * 80).alias("text"))
    out = repeats_removed(df.repartition(8), 50, outputs=("n_removed",))
    parts = out.select(F.spark_partition_id().alias("p"), "n_removed").groupBy("p", "n_removed").count()
    found = parts.collect()
    assert sum(r["count"] for r in found) == 1000 and {r.n_removed for r in found} == {0}
    assert max(r["count"] for r in found) < 500


def test_groups_are_larger_than_shards(spark, monkeypatch):
    rows, asked = documents(), []
    sender = repeats._key_sender
    monkeypatch.setattr(repeats, "_key_sender", lambda length, shards: asked.append(shards) or sender(length, shards))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    total = sum(len((text or "").encode()) for _, text in rows)
    got = repeats_removed(df.repartition(5), 50, 4000, outputs=OUTPUTS, shard_bytes=500)
    got = [(r.row.doc_id, *[r[c] for c in OUTPUTS]) for r in got.collect()]
    assert sorted(got, key=str) == sorted([r[:7] for r in brute(rows, 50)], key=str)
    assert asked == [-(-total // 500)]

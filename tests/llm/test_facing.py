"""What meets in buckets that span several components, and that nothing staged is left."""

import itertools
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pathfeat.llm import minhash
from pathfeat.llm.minhash import near_duplicates
from pathfeat.llm.tokens import append_misses, token_counts
from pathfeat.plans.staging import Staging

PATH = public_tokenizers.path("byte_bpe_50k.json")
MEMBERS = "bucket bigint, rep bigint, size bigint, least bigint, component bigint"


def _members(spark, components):
    """One bucket whose members are in components of the given sizes."""
    rows, rep = [], 0
    total = sum(components)
    for size in components:
        first = rep
        for _ in range(size):
            rows.append((1, rep, total, 0, first))
            rep += 1
    frame = spark.createDataFrame(rows, MEMBERS)
    texts = frame.select(
        F.col("rep").alias("key"), F.lit("t").alias("text"), F.lit(1).alias("bytes"), F.lit(b"s").alias("sig")
    )
    return frame, texts


def test_a_stray_sends_each_member_once(spark):
    members, texts = _members(spark, [9_999, 1])
    sent = minhash._facing(members, texts, most_chunks=32)
    assert sent.count() < 3 * 10_000


@pytest.mark.parametrize("most_chunks", [32, 0])
@pytest.mark.parametrize("sizes", [[40, 1], [12, 12, 12], [30, 5, 5, 1, 1], [1] * 25])
def test_every_pair_of_different_components_meets(spark, monkeypatch, sizes, most_chunks):
    monkeypatch.setattr(minhash, "_CHUNK", 4)
    members, texts = _members(spark, sizes)
    rows = minhash._facing(members, texts, most_chunks).collect()
    component, met = {}, set()
    groups: dict = {}
    for r in rows:
        component[r.rep] = r.component
        groups.setdefault((r.grp, r.apart, r.i, r.j), []).append(r)
    for (_, _, i, j), own in groups.items():
        first, second = [r.rep for r in own if r.chunk == i], [r.rep for r in own if r.chunk == j]
        assert len(first) == len(set(first)) and len(second) == len(set(second))
        met |= {frozenset(p) for p in itertools.product(first, second) if p[0] != p[1]}
    want = {frozenset(p) for p in itertools.combinations(component, 2) if component[p[0]] != component[p[1]]}
    assert len(component) == sum(sizes) and want <= met


def test_long_members_are_dealt_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(minhash, "_CHUNK_BYTES", 1000)
    members, texts = _members(spark, [20, 20])
    rows = minhash._facing(members, texts.withColumn("bytes", F.lit(500)), 32).collect()
    assert len({r.chunk for r in rows}) > 10


def test_nothing_staged_is_left(spark, tmp_path):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=40)) for _ in range(5)]
    rows = [(i, base[i % 5] + f" x{i % 7}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    with Staging(str(tmp_path)) as scope:
        results = [near_duplicates(docs), token_counts(docs, PATH)]
        names = sorted(p.name.rsplit("-", 1)[0] for p in (tmp_path / "pathfeat").iterdir())
        assert names == ["near-duplicates", "token-counts"]
        assert [r.count() for r in results] == [60, 60]
    scope.close()
    assert not [*(tmp_path / "pathfeat").iterdir()]


def test_a_warm_cache_asks_for_missing_texts_only(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(50)], "doc_id bigint, text string")
    cache = str(tmp_path / "cache")
    append_misses(docs, cache, PATH)
    more = docs.union(spark.createDataFrame([(99, "a new text"), (98, "a new text")], docs.schema))
    got = {r.doc_id: r.n_tokens for r in token_counts(more, PATH, cache).collect()}
    assert got == {r.doc_id: r.n_tokens for r in token_counts(more, PATH).collect()}
    assert spark.read.parquet(cache).count() == 51


def test_a_cache_needs_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr("pathfeat.llm.tokens.staging_root", lambda spark: None)
    docs = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        token_counts(docs, PATH)

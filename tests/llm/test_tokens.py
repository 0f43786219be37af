import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import AWKWARD
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pathfeat.llm.bpe import Encoder
from pathfeat.llm.columns import text_bytes
from pathfeat.llm.packing import pack_group, packed
from pathfeat.llm.tokens import append_misses, new_cache, read_cache, token_counts, tokenizer_version

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
FORGETFUL = Encoder(PATH, most_pieces=5)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_the_library_s(name):
    path = public_tokenizers.path(name)
    library, own, rnd = Tokenizer.from_file(path), Encoder(path), random.Random(7)
    parts = "a,b, ,  ,\n,'s,',' ','ll,'re,1,23,!,é, ,\t,'t,x,漢,😀,<|endoftext|>,\U000105c0".split(",")
    parts += ["́", "r", "e", "v", "s", "\x1c", "\x00", ","]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(3000)]
    raw, offsets = text_bytes(pa.array(texts))
    ids, at = own.encode(raw, offsets)
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == library.encode(t, add_special_tokens=False).ids, t
    assert own.counts(raw, offsets).tolist() == np.diff(at).tolist()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_ids_of_any_text(texts):
    ids, at = FORGETFUL.encode(*text_bytes(pa.array(texts, pa.string())))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [library_ids(t) for t in texts]


def test_counts(awkward, empty):
    got = sorted(map(tuple, token_counts(awkward, PATH, limit=20).collect()), key=str)
    want = []
    for i, t in AWKWARD:
        n = len(library_ids(t))
        want.append((i, len((t or "").encode()), n, n > 20))
    assert got == sorted(want, key=str)
    assert token_counts(empty, PATH).collect() == []


def test_cache_gets_each_content_once(spark, awkward):
    cache, version = new_cache(awkward), tokenizer_version(PATH)
    append_misses(awkward, cache, PATH)
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for _, t in AWKWARD})
    append_misses(awkward, cache, PATH)
    assert spark.read.parquet(cache).count() == stored.count()
    more = spark.createDataFrame([(1, "one new text"), (2, "")], "doc_id bigint, text string")
    first = token_counts(more, PATH, cache).collect()
    assert len(first) == 2
    assert read_cache(more, cache, version).count() == len({t or "" for _, t in AWKWARD}) + 1
    assert read_cache(more, cache, "another version").count() == 0


def test_packing(awkward, empty):
    rows = packed(awkward, PATH, capacity=128, end_id=1, group_tokens=1000, with_ids=True).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id].append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 128
    for i, t in AWKWARD:
        whole = library_ids(t) + [1]
        assert all(r.doc_tokens == len(whole) for r in pieces[i])
        own = sorted(pieces[i], key=lambda r: r.start)
        if i != 6:
            assert [x for r in own for x in r.ids] == whole
        else:
            assert sum(r.length for r in own) == 2 * len(whole)
    assert packed(empty, PATH).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=40), st.integers(1, 20))
def test_groups_take_no_more_sequences_than_needed(lengths, capacity):
    rows = pack_group(np.array(lengths, np.int64), capacity)
    filled = defaultdict(int)
    for _, _, n, sequence, offset in sorted(rows.tolist(), key=lambda r: (r[3], r[4])):
        assert offset == filled[sequence] and n > 0
        filled[sequence] += n
    assert all(n <= capacity for n in filled.values())
    full = sum(n // capacity for n in lengths)
    assert len(filled) <= full + -(-sum(n % capacity for n in lengths) // capacity)
    for d, n in enumerate(lengths):
        own = sorted(r[1:3].tolist() for r in rows if r[0] == d)
        assert sum(x for _, x in own) == n
        assert [s for s, _ in own] == [sum(x for _, x in own[:i]) for i in range(len(own))]


def test_costs_are_even():
    lengths = np.random.default_rng(3).integers(20, 900, 400)
    rows = pack_group(lengths, 2048)
    n, sequence = rows[:, 2].astype(float), rows[:, 3]
    spent = np.bincount(sequence, n + n * n / 1024)
    by_order = np.arange(len(lengths)) * (sequence.max() + 1) // len(lengths)
    plain = np.bincount(by_order, lengths + lengths.astype(float) ** 2 / 1024)
    assert spent.std() < 0.5 * plain.std()

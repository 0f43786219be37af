"""Unlike texts that polynomial hashes modulo a power of two can't tell apart."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pathfeat.llm import columns
from pathfeat.llm.bpe import Encoder
from pathfeat.llm.columns import _PRIME, _base_powers, _product, _reduced, _shifted, span_hashes
from pathfeat.llm.decontaminate import contamination
from pathfeat.llm.minhash import near_duplicates
from pathfeat.llm.packing import packed
from pathfeat.llm.tokens import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def thue_morse(n: int) -> tuple[str, str]:
    """A word of two letters and its complement."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


SIZES = [64, 128, 256, 512, 1024, 2048, 4096]


def test_arithmetic():
    rng = np.random.default_rng(1)
    p = int(_PRIME)
    a, b = (rng.integers(0, p, 1000, dtype=np.uint64) for _ in range(2))
    a[:3], b[:3] = [0, p - 1, 1], [p - 1, p - 1, 0]
    assert _product(a, b).tolist() == [x * y % p for x, y in zip(a.tolist(), b.tolist())]
    assert _shifted(a).tolist() == [x * 2**31 % p for x in a.tolist()]
    big = rng.integers(0, 2**64 - 1, 1000, dtype=np.uint64)
    assert _reduced(big).tolist() == [x % p for x in big.tolist()]
    power, inverse = _base_powers(70_000)
    assert set(_product(power, inverse).tolist()) == {1}


@pytest.mark.parametrize("kind, top", [(np.uint8, 256), (np.uint32, 0x110000)])
def test_span_hashes(kind, top):
    rng = np.random.default_rng(2)
    values = rng.integers(top - 3, top, 5000).astype(kind)
    starts = rng.integers(0, 4980, 4000)
    ends = starts + rng.integers(0, 9, 4000)
    by: dict[tuple, set] = {}
    for h, a, b in zip(span_hashes(values, starts, ends).tolist(), starts, ends):
        by.setdefault(tuple(values[a:b].tolist()), set()).add(h)
    assert all(len(x) == 1 for x in by.values())
    assert len({min(x) for x in by.values()}) == len(by)


def test_thue_morse_words_differ():
    for n in SIZES:
        both = "".join(thue_morse(n)).encode()
        h = span_hashes(np.frombuffer(both, np.uint8), np.array([0, n]), np.array([n, 2 * n]))
        assert h[0] != h[1], n


def _frame(spark, n):
    a, b = thue_morse(n)
    rows = [(1, f"x {a} y"), (2, f"x {b} y"), (3, a), (4, b)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_token_ids(library):
    encoder = Encoder(PATH)
    for n in SIZES:
        texts = [*thue_morse(n)]
        raw = np.frombuffer("".join(texts).encode(), np.uint8)
        ids, at = encoder.encode(raw, np.array([0, n, 2 * n]))
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want


def test_pieces_that_share_a_hash_are_told_apart(library, monkeypatch):
    monkeypatch.setattr("pathfeat.llm.bpe.span_hashes", lambda v, s, e: (e - s).astype(np.uint64) + np.uint64(1))
    encoder = Encoder(PATH)
    texts = ["the cat sat on the mat, and the dog", "été 12345 漢字 the", "", "a b c d e f g h", "\x00a \x00b"] * 3
    data = [t.encode() for t in texts]
    at = np.cumsum([0] + [len(d) for d in data])
    ids, edge = encoder.encode(np.frombuffer(b"".join(data), np.uint8), at)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(edge, edge[1:])] == want


@pytest.mark.parametrize("n", [256, 1024])
def test_operators(spark, library, n):
    docs = _frame(spark, n)
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    assert {r.doc_id: r.n_tokens for r in token_counts(docs, PATH).collect()} == {i: len(x) for i, x in want.items()}
    import zlib

    whole = {i: zlib.crc32(np.array([*x, 1], "<u4").tobytes()) for i, x in want.items()}
    got = {r.doc_id: r.ids_crc32 for r in packed(docs, PATH, 2048, end_id=1).collect() if r.start == 0 and r.length == r.doc_tokens}
    assert got == {i: whole[i] for i in got} and len(got) >= 3
    assert all(r.component_id == r.doc_id for r in near_duplicates(docs).collect())
    bench = spark.createDataFrame([("i", texts[1])], "item_id string, text string")
    found = {r.doc_id: r.n_hit for r in contamination(docs, bench).collect()}
    assert found == {1: 3, 2: 0, 3: 0, 4: 0}


def test_hashes_of_no_values():
    none = np.zeros(0, np.int64)
    assert len(columns.span_hashes(np.zeros(0, np.uint8), none, none)) == 0

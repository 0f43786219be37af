import hashlib
import random

import duckdb

from pathfeat.llm.oracles import ORACLES
from pathfeat.llm.secrets import secret_spans, span_digest


def _spans(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.row.doc_id: r.spans for r in secret_spans(docs, **options).collect()}
    return [[(s.kind, s.start, s.end) for s in found[i]] for i in range(len(texts))]


def test_strong_kinds_stand_alone(spark):
    hex24, key = "0123456789abcdef01234567", "AKIA" + "Q" * 16
    texts = [
        "x password=hunter22 y", "token: 'abc12' no", f"é漢 {hex24}!", f"{key} {key[:-1]}",
        'API_KEY" : "abcdef', "secret=token:abcdefgh", "password==abcdef", None, "", f"x{key}1y", hex24[:-1],
    ]
    assert _spans(spark, texts) == [
        [("assign", 2, 19)], [], [("hex", 3, 27)], [("access", 0, 20)],
        [("assign", 0, 18)], [], [("assign", 0, 16)], [], [], [("access", 1, 22)], [],
    ]


def test_weak_parts_need_each_other(spark):
    opaque, near = "Zm9vYmFyMTIzNDU2Nzg5", " and then "
    alone = [f"user=alice{near}", opaque, "https://db.example/x"]
    assert _spans(spark, alone) == [[], [], []]
    both, scope, far = f"user=alice{near}{opaque}", f"user=alice\n \n{opaque}", f"user=alice{',' * 200}{opaque}"
    linked, apart, distant = _spans(spark, [both, scope, far])
    assert linked == [("ident", 0, 10), ("opaque", 20, 40)]
    assert apart == distant == []
    assert _spans(spark, [far], reach=200) == [[("ident", 0, 10), ("opaque", 210, 230)]]
    whole = f"https://db.example/x login: bob {opaque}"
    assert _spans(spark, [whole]) == [[("endpoint", 0, 20), ("ident", 21, 31), ("opaque", 32, 52)]]
    # An endpoint needs both others; its own path is no secret beside it.
    assert _spans(spark, ["https://x.example/Zm9vYmFyMTIzNDU2Nzg5", "host=a1b user=bob"]) == [[], []]


def test_awkward_rows(spark, awkward, empty):
    rows = span_digest(secret_spans(awkward)).collect()
    assert len(rows) == awkward.count()
    nothing = hashlib.sha256(b"").hexdigest()
    assert {(r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in rows} == {(0, 0, 0, nothing, "")}
    assert secret_spans(empty).count() == 0
    long = "token=abcdef " * 50_000
    (found,) = span_digest(secret_spans(spark.createDataFrame([(1, long)], "doc_id bigint, text string"))).collect()
    assert found.n_assign == 50_000


def test_random_texts_equal_sql(spark):
    rng = random.Random(7)
    words = [
        "password", "Secret", "token", "api_key", "API-KEY", "ſecret", "user", "login", "host", "endpoint",
        "AKIA", "AKIAKIA", "ABCDEFGHIJKLMNOP", "0123456789", "abcdef0123456789abcdef", "Zm9vYmFyMTIzNDU2Nzg5",
        "https://", "a.b/c", "=", ":", " ", "  ", "'", '"', "\n", "\n\n", "\n \r\n", "é", "漢字", ".", "x", "-", "@", "\U0001f600",
    ]
    texts = ["".join(rng.choices(words, k=rng.randint(0, 120))) for _ in range(400)]
    rows = [(i % 390 or None, t if i % 97 else None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    got = span_digest(secret_spans(docs.repartition(3))).select("row.doc_id", *names).collect()
    db = duckdb.connect()
    db.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    want = db.execute(ORACLES["op13_secrets"]).fetchall()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    kinds = {s.split(":")[0] for r in want for s in r[5].split(",") if s}
    assert kinds == {"assign", "access", "hex", "ident", "opaque", "endpoint"}

import random

import public_tokenizers
import pytest
from cases import AWKWARD
from test_decontaminate import brute as contaminated
from test_minhash import brute as components
from test_repeats import brute as repeats
from tokenizers import Tokenizer

import corpus_pipeline

INSULTS = ["vexlark", "vexlorn", "grubnik"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rnd = random.Random(12)
    vocabulary = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9))) for _ in range(500)]
    text = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    items = [(i, text(20)) for i in range(5)]
    docs, toxic = [], set()
    for i in range(400):
        w = text(rnd.randint(30, 90)).split()
        if i % 5 == 0:
            toxic.add(i)
            for _ in range(5):
                w.insert(rnd.randint(0, len(w)), rnd.choice(INSULTS) + rnd.choice(["", "a", "ed"]))
        if i % 7 == 1:
            w[10:10] = items[i % 5][1].split()
        docs.append((i, " ".join(w)))
    shared = text(60)
    for i in range(400, 420):
        docs.append((i, text(20) + " " + shared + " " + text(20)))
    for i in range(420, 450):
        w = docs[i - 300][1].split()
        w[3] = "changed"
        docs.append((i, " ".join(w)))
        toxic |= {i} if i - 300 in toxic else set()
    docs += [(None if k is None else 5000 + k, t) for k, t in AWKWARD if k != 6]
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(*d, "en", f"s{n % 3}", 0, "x") for n, d in enumerate(docs)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(400) if i % 3 != 2]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs, toxic, items


def by_hand(docs, toxic, items):
    """What every stage but the last leaves, each on what the one before left."""
    out = [[d for d in docs if d[0] not in toxic]]
    kept = {r[0] for r in components(out[-1]) if r[3]}
    out.append([d for d in out[-1] if d[0] in kept])
    cut = []
    for (key, text), r in zip(out[-1], repeats(out[-1], 50)):
        left = r[7].decode(errors="ignore") if r[2] else text
        if not r[2] or left.strip(" "):
            cut.append((key, left))
    out.append(cut)
    clean = []
    for key, text in cut:
        (r,) = contaminated([(key, text)], items, 13, 20)
        if r[5]:
            data, at, parts = text.encode(), 0, []
            for a, b in zip(r[6], r[7]):
                parts.append(data[at:a])
                at = b
            text = b"".join([*parts, data[at:]]).decode()
        clean.append((key, text))
    out.append(clean)
    return out


def test_stages(spark, tables, tmp_path):
    folder, docs, toxic, items = tables
    table = spark.read.parquet(f"{folder}/documents.parquet")
    columns = table.columns
    want = by_hand(docs, toxic, items)
    sizes = [len(docs), *map(len, want)]
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] and want[2] != want[3]
    for (name, step), rows in zip(corpus_pipeline.STAGES, want):
        result = step(spark, table, folder)
        assert result.columns == columns, name
        result.write.parquet(str(tmp_path / name))
        table = spark.read.parquet(str(tmp_path / name))
        got = sorted([(r.doc_id, r.text) for r in table.collect()], key=str)
        assert got == sorted(rows, key=str), name
    pieces = corpus_pipeline.STAGES[-1][1](spark, table, folder).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for key, text in want[-1]:
        n = len(library.encode(text or "", add_special_tokens=False).ids) + 1
        assert sum(r.length for r in pieces if r.doc_id == key) == n
    assert sorted((r.doc_id is None, r.doc_id or 0, r.start, r.ids_crc32) for r in pieces) == sorted(
        (r.doc_id is None, r.doc_id or 0, r.start, r.ids_crc32)
        for r in corpus_pipeline.run(spark, folder).collect()
    )


def test_empty_documents(spark, tables, tmp_path):
    folder = tables[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id = -1")
    for _, step in corpus_pipeline.STAGES:
        result = step(spark, docs, folder)
        assert result.collect() == []
        docs = result

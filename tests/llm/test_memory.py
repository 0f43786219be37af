"""Worker processes: one for each core, which give back what earlier tasks kept. The
driver's JVM gives back what the threads of earlier jobs freed."""

import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pathfeat.llm import minhash, repeats, toxicity
from pathfeat.llm.columns import kept_by_worker


def test_near_duplicates_run_one_worker_a_task(spark, monkeypatch):
    plans = []

    def staged(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stage(df, name)

    stage = minhash.stage
    monkeypatch.setattr(minhash, "stage", staged)
    texts = [f"{'same words in all of these texts ' * 9}{'tail ' * (i % 3)}{i // 6}" for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert minhash.near_duplicates(docs).where("not kept").count()
    assert sum("InArrow" in p for p in plans) >= 3
    for plan in plans:
        # No Python step feeds another one of its own task.
        assert not re.search(r"InArrow[^\n]*\n\W*(Project[^\n]*\n\W*)*MapInArrow", plan), plan


def _tables():
    texts = ["a text that is not long", "another one, a little longer than the first " * 3]
    table = pa.table({"key": [1, 2], "text": texts, "row": [{"doc_id": 1}, {"doc_id": 2}]})
    return table.append_column("grp", pa.array([0, 0], pa.int32()))


@pytest.mark.parametrize("step", ["keys", "cut", "profiles"])
def test_tasks_give_back_what_others_keep(step):
    made = kept_by_worker(lambda: object())
    before, table = made(), _tables()
    if step == "keys":
        assert repeats._key_sender(50, 4)(table).num_rows
    elif step == "cut":
        marks = pa.table({"payload": pa.array([], pa.binary()), "size": pa.array([], pa.int64())})
        assert repeats._cutter(("n_bytes",))(table, marks).num_rows == 2
    else:
        assert [*minhash._profiles(5, 25)(iter(table.to_batches()))][0].num_rows == 2
    assert made() is not before


def _native_mb(spark):
    """MB that the driver's JVM holds in the heaps of malloc: they lie at multiples of 64 MB."""
    pid = spark._jvm.java.lang.ProcessHandle.current().pid()
    total = 0
    with open(f"/proc/{pid}/smaps") as maps:
        for m in re.finditer(r"^([0-9a-f]+)-([0-9a-f]+) rw-p .*\n((?:[A-Z].*\n)+)", maps.read(), re.M):
            a, b = int(m[1], 16), int(m[2], 16)
            if a >> 32 and a % (64 << 20) == 0 and b - a <= 64 << 20:
                total += int(re.search(r"^Anonymous:\s+(\d+)", m[3], re.M)[1])
    return total / 1024


def _freed_between(spark):
    """Native memory freed in pieces between others that are in use, which stay so."""
    made = [spark._jvm.java.util.zip.Deflater() for _ in range(600)]
    for deflater in made[::2]:
        deflater.end()
    return made[1::2]


@pytest.mark.parametrize("step", ["near duplicates", "toxicity"])
def test_driver_gives_back_freed_memory(spark, step):
    texts = [f"{'same words in all of these texts ' * 9}{'tail ' * (i % 3)}{i // 6}" for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id bigint, toxic int")

    def run():
        if step == "near duplicates":
            minhash.near_duplicates(docs)
        else:
            toxicity.fit(docs, labels, F.lit(True))

    run()
    kept = _freed_between(spark)
    before = _native_mb(spark)
    run()
    assert _native_mb(spark) < before - 15
    assert len(kept) == 300

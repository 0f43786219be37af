import math
import random

import pytest
from pyspark.sql import functions as F

from pathfeat.llm.top_k import top_k


def brute(rows, k, every):
    usable = []
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, [math.floor(1024 * x) for x in v]))
    queries = {}
    for i, v in usable:
        if i % every == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        scores = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q and len(w) == len(v)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [4096, 3])
def test_top_k(spark, block_rows):
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(20)]) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)]  # ties
    rows += [(5, rows[5][1]), (10, rows[11][1]), (None, rows[0][1]), (400, None), (401, [])]
    rows += [(402, [None] * 20), (403, [math.nan] * 20), (404, [math.inf] * 20), (405, [-math.inf] * 20)]
    rows += [(410, [1.0, 2.0]), (411, [3.0, -1.0]), (420, [0.0] * 20), (421, [1e3] * 20)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<double>, rank int")
    got = top_k(df.repartition(4), F.col("id") % 10 == 0, 7, block_rows=block_rows)
    assert sorted(map(tuple, got.collect())) == brute(rows, 7, 10)
    assert top_k(df.where("vec_id > 5000"), F.col("id") % 10 == 0, 7).collect() == []


def test_large_components_are_exact(spark):
    rnd = random.Random(7)
    rows = [(i, [rnd.gauss(0, 1e5) for _ in range(20)]) for i in range(60)]
    rows += [(100 + i, [1.75e6, -1.75e6, rnd.uniform(0, 1e6)]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = top_k(df.repartition(3), F.col("id") % 10 == 0, 7)
    assert sorted(map(tuple, got.collect())) == brute(rows, 7, 10)


def test_scores_beyond_64_bits_are_an_error(spark):
    df = spark.createDataFrame([(i, [1e300, 1.0]) for i in range(3)], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        top_k(df, F.col("id") == 0, 2).collect()

"""Linear models as tables, against Spark ML and SQL on the stored weights."""

import duckdb
import pytest
from pyspark.sql import functions as F

from pathfeat.operators.classify import ModelOptions, cross_validate, linear_models
from pathfeat.plans.staging import Staging

MARGINS = """SELECT v.a, v.b, v.label, v.fold, f.fold AS model, sum(c.n * coalesce(w.weight, 0)) AS m
FROM vectors v CROSS JOIN (SELECT DISTINCT fold FROM weights) f
JOIN cells c ON c.a = v.a AND c.b = v.b LEFT JOIN weights w ON w.id = c.id AND w.fold = f.fold GROUP BY ALL"""
SLOPE = {
    "logistic": "1 / (1 + exp(-m)) - CASE WHEN label THEN 1 ELSE 0 END",
    "linear_svc": "CASE WHEN label AND m < 1 THEN -1.0 WHEN NOT label AND m > -1 THEN 1.0 ELSE 0.0 END",
}


def vectors(spark):
    i = F.col("id")
    noise = F.pmod(F.xxhash64(i), F.lit(7)) < 2
    cell = lambda k: F.struct(F.lit(k).cast("bigint").alias("id"), (F.pmod(F.xxhash64(i, F.lit(k)), F.lit(4)) + F.lit(1)).cast("bigint").alias("n"))
    cells = F.array(*[F.when(F.pmod(F.xxhash64(F.lit(k), i), F.lit(3)) > 0, cell(k)) for k in range(4)])
    kept = F.array_compact(cells)
    label = (F.coalesce(F.get(cells, F.lit(1))["n"], F.lit(0)) > 1) != noise
    rows = spark.range(300).select(F.format_string("a%03d", i).alias("a"), F.lit("b").alias("b"), label.alias("label"), kept.alias("cells"))
    return rows.where(F.size("cells") > 0)


@pytest.mark.parametrize("kind", ["logistic", "linear_svc"])
def test_predictions_and_gradients(spark, tmp_path, kind):
    options = ModelOptions(max_iter=200)
    with Staging(str(tmp_path / "staging")) as scope:
        sparse = vectors(spark)
        fitted = linear_models(sparse, 5, kind, 3, options)
        by_ml = cross_validate(sparse, 5, kind, 3, options)
        got = {(r.a, r.fold, r.prediction): r.score for r in fitted.predictions().collect()}
        want = {(r.a, r.fold, r.prediction): r.score for r in by_ml.collect()}
        assert got.keys() == want.keys() and len(got) > 250
        assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in got)
        gradient = {(r.fold, r.id): (r.weight, r.gradient) for r in fitted.gradient().collect()}
        fitted.data.select("a", "b", "label", "fold").write.parquet(str(tmp_path / "vectors"))
        fitted.weights.write.parquet(str(tmp_path / "weights"))
        one = F.array(F.struct(F.lit(-1).cast("bigint").alias("id"), F.lit(1).cast("bigint").alias("n")))
        cells = fitted.data.select("a", "b", F.inline(F.concat("cells", one)))
        cells.write.parquet(str(tmp_path / "cells"))
        db = duckdb.connect()
        for t in ("vectors", "weights", "cells"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}/*.parquet')")
        rows = db.execute(
            f"""WITH margins AS ({MARGINS}), training AS (SELECT *, {SLOPE[kind]} AS slope FROM margins WHERE fold <> model),
            sizes AS (SELECT model, count(*) AS r FROM training GROUP BY model),
            sums AS (SELECT t.model, c.id, sum(c.n * slope) AS g, sum(c.n) AS s, sum(c.n * c.n) AS q
              FROM training t JOIN cells c ON c.a = t.a AND c.b = t.b GROUP BY ALL)
            SELECT s.model, s.id, coalesce(weight, 0), g / r + CASE WHEN s.id = -1 THEN 0 ELSE
              {fitted.reg_param} * coalesce(weight, 0) * (q - s * s / r) / (r - 1) END
            FROM sums s JOIN sizes USING (model) LEFT JOIN weights w ON w.fold = s.model AND w.id = s.id"""
        ).fetchall()
        assert {(f, i) for f, i, *_ in rows} == gradient.keys() and len(rows) == 3 * 5
        for fold, i, weight, slope in rows:
            assert gradient[fold, i] == pytest.approx((weight, slope), abs=1e-9)
        if kind == "logistic":
            assert max(abs(g) for _, g in gradient.values()) < 1e-3
            # Moved weights are not the optimum.
            fitted.weights = fitted.weights.withColumn("weight", F.col("weight") + 0.3)
            assert max(abs(r.gradient) for r in fitted.gradient().collect()) > 1e-2
    scope.close()


def test_only_linear_models(spark):
    with pytest.raises(ValueError, match="linear"):
        linear_models(vectors(spark), 5, "decision_tree")

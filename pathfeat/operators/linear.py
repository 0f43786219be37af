"""Linear models of all folds as a table, with a certificate that they are what was asked for.

Spark ML fits one model per fold. Their weights become rows ``fold, id, weight``, the
intercept being the weight of the id -1, of which every vector has one. From then on the
models are data: predictions are joins and sums over cells, and so is the gradient of the
objective over all training rows of every fold, which is zero at the optimum of a logistic
model. It takes two joins for all folds together, with the weights of an id side by side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INTERCEPT = -1
WEIGHTS = "fold int, id bigint, weight double"


def weights_table(spark: SparkSession, models: dict[int, Model]) -> DataFrame:
    """``fold, id, weight`` of the weights that are not zero, and every intercept. The
    driver holds as many numbers as the fits did."""
    rows = []
    for fold, model in models.items():
        weights = model.coefficients.toArray()
        rows += [(fold, int(i), float(weights[i])) for i in weights.nonzero()[0]]
        rows.append((fold, INTERCEPT, float(model.intercept)))
    return spark.createDataFrame(rows, WEIGHTS)


def _cells(data: DataFrame) -> DataFrame:
    one = F.struct(F.lit(INTERCEPT).cast("bigint").alias("id"), F.lit(1).cast("bigint").alias("n"))
    return data.select("a", "b", "fold", "label", F.inline(F.concat("cells", F.array(one))))


@dataclass
class LinearModels:
    """``data`` are vectors ``a, b, label, cells, fold``, ``weights`` the table above;
    ``kind`` is logistic or linear_svc, ``reg_param`` weighs half the sum of the squared
    standardised weights."""

    data: DataFrame
    weights: DataFrame
    used: list[int]
    kind: str
    reg_param: float = 0.0

    def predictions(self) -> DataFrame:
        """``a, b, label, fold, score, prediction`` by the model of the row's own fold, which
        was fitted without it."""
        margins = (
            _cells(self.data)
            .join(self.weights, ["fold", "id"], "left")
            .groupBy("a", "b", "label", "fold")
            .agg(F.sum(F.col("n") * F.coalesce("weight", F.lit(0.0))).alias("_m"))
        )
        true = F.col("_m") > 0
        score = 1 / (1 + F.exp(-F.col("_m"))) if self.kind == "logistic" else true.cast("double")
        return margins.select("a", "b", "label", "fold", score.alias("score"), true.alias("prediction"))

    def _slope(self, margin: Column, label: Column) -> Column:
        """Of a row's loss, by its margin."""
        if self.kind == "logistic":
            return 1 / (1 + F.exp(-margin)) - label.cast("double")
        sign = F.when(label, 1.0).otherwise(-1.0)
        return F.when(sign * margin < 1, -sign).otherwise(0.0)

    def gradient(self) -> DataFrame:
        """``fold, id, weight, gradient``: of the mean loss over the fold's training rows and
        the penalty, by every weight, zero weights included."""
        cells = _cells(self.data)
        beside = self.weights.groupBy("id").pivot("fold", self.used).agg(F.first("weight"))
        beside = beside.select("id", *[F.col(str(f)).alias(f"w{f}") for f in self.used])
        weighted = cells.join(beside, "id", "left")
        margins = weighted.groupBy("a", "b").agg(
            *[F.sum(F.col("n") * F.coalesce(f"w{f}", F.lit(0.0))).alias(f"m{f}") for f in self.used]
        )
        trains = {f: F.col("fold") != f for f in self.used}
        n, slopes = F.col("n").cast("double"), cells.join(margins, ["a", "b"])
        sums = slopes.groupBy("id").agg(
            *[F.sum(F.when(t, n * self._slope(F.col(f"m{f}"), F.col("label")))).alias(f"g{f}") for f, t in trains.items()],
            *[F.sum(F.when(t, n)).alias(f"s{f}") for f, t in trains.items()],
            *[F.sum(F.when(t, n * n)).alias(f"q{f}") for f, t in trains.items()],
        )
        totals = self.data.agg(*[F.count_if(t).cast("double").alias(f"r{f}") for f, t in trains.items()])
        parts = [
            F.struct(
                F.lit(f).alias("fold"),
                totals.select(f"r{f}").scalar().alias("rows"),
                *[F.coalesce(f"{c}{f}", F.lit(0.0)).alias(c) for c in ("w", "g", "s", "q")],
            )
            for f in self.used
        ]
        each = sums.join(beside, "id", "left").select("id", F.inline(F.array(*parts)))
        rows = F.col("rows")
        variance = (F.col("q") - F.col("s") * F.col("s") / rows) / F.greatest(rows - 1, F.lit(1.0))
        penalty = F.when(F.col("id") == INTERCEPT, 0.0).otherwise(self.reg_param * F.col("w") * variance)
        return each.select("fold", "id", F.col("w").alias("weight"), (F.col("g") / rows + penalty).alias("gradient"))

"""Arcs and rejects of a corpus from one read of its lines.

Every line is parsed once and written once, as an arc or as a reject, into a table that is
partitioned by which of the two it is; reading one kind touches none of the other's files.
The number of each is in the footers of the table's files.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.parse import route_arcs
from ..plans.staging import Staging, staging_root

ARC, REJECT = "arc", "reject"


@dataclass
class RoutedLines:
    """``arcs`` as ``parse_arcs`` gives them, ``rejects`` as ``reject_arcs`` does."""

    arcs: DataFrame
    rejects: DataFrame
    n_arcs: int
    n_rejects: int

    @property
    def counts(self) -> DataFrame:
        """``kind, n`` of either kind."""
        rows = [("arcs", self.n_arcs), ("rejects", self.n_rejects)]
        return self.arcs.sparkSession.createDataFrame(rows, "kind string, n bigint").coalesce(1)


def stage_routed(lines: DataFrame, staging: Staging, value: str = "value") -> RoutedLines:
    """Read the lines once and stage both kinds, deleted when ``staging`` is closed."""
    spark, routed = lines.sparkSession, route_arcs(lines, value)
    kind = F.col("kind")
    with staging:
        root = staging_root(spark)
    if root is None:
        stored = routed.persist(StorageLevel.DISK_ONLY)
        staging.keep(stored)
    else:
        path = f"{root}/pathfeat/routed-{uuid.uuid4().hex}"
        staging.add(spark, path)
        routed.write.partitionBy("kind").parquet(path)
        stored = spark.read.schema(routed.schema).parquet(path)
    keys = [c for c in lines.columns if c != value]
    # One row per kind.
    n = {r["kind"]: r["count"] for r in stored.groupBy("kind").count().collect()}
    return RoutedLines(
        stored.where(kind == ARC).select(*keys, "head", "toks"),
        stored.where(kind == REJECT).select(*keys, value, "reason"),
        n.get(ARC, 0),
        n.get(REJECT, 0),
    )

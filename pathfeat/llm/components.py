"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of all nodes of ``a, b`` edges, the component being its least
    node.

    Rounds of contraction: every node hooks onto its least neighbour, chains of hooks
    are followed to their ends by doubling, and the edges between different ends go into
    the next round. Ends at least halve each round. Each round's tables are staged, so a
    lost executor costs no earlier round. Nodes are never brought to the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    left = stage(both.where("a != b").distinct(), "edges")
    labels = None
    while not left.isEmpty():
        hooks = left.groupBy("a").agg(F.min("b").alias("to"))
        hooks = hooks.select(F.col("a").alias("node"), F.least("a", "to").alias("component"))
        hooks = _ends(stage(hooks, "hooks"))
        ends = hooks.select(F.col("node").alias("b"), F.col("component").alias("to_b"))
        left = (
            left.join(hooks.withColumnRenamed("node", "a"), "a")
            .join(ends, "b")
            .where("component != to_b")
            .select(F.col("component").alias("a"), F.col("to_b").alias("b"))
            .distinct()
        )
        left = stage(left, "edges")
        labels = hooks if labels is None else stage(_follow(labels, hooks), "labels")
    if labels is None:
        labels = left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels


def _follow(labels: DataFrame, hooks: DataFrame) -> DataFrame:
    """Each component replaced by what it hooks onto, if anything."""
    to = hooks.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    return labels.join(to, "component", "left").select(
        "node", F.coalesce("_to", "component").alias("component")
    )


def _ends(hooks: DataFrame) -> DataFrame:
    while True:
        further = hooks.alias("x").join(
            hooks.where("node != component").select(
                F.col("node").alias("component"), F.col("component").alias("_to")
            ),
            "component",
            "left",
        )
        further = further.select(
            "node",
            F.coalesce("_to", "component").alias("component"),
            F.col("_to").isNotNull().alias("_moved"),
        )
        further = stage(further, "hooks")
        hooks = further.drop("_moved")
        if further.where("_moved").isEmpty():
            return hooks

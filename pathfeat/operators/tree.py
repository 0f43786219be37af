"""Decision trees on sparse counts, of all folds at once, by exact entropy splits.

One tree is grown for every fold, from the rows outside it. A level of all trees takes
one aggregate: class histograms per (tree, node, path id, count). Rows are first counted
by the nodes they are in, which is an array of one node per tree; as the trees of
different folds agree on most splits, few such arrays are left, and only these counts are
dealt out to the trees. Zeros are never stored: what the counts of a path leave of a
node's total holds zeros. Every distinct count is a candidate threshold, so nothing is
binned.

A node is split where the information gain, rounded to twelve digits, is largest; ties go
to the smaller path id, then to the smaller threshold. Rows with at least ``at`` of the
path go right. A node without a split of positive gain that leaves ``min_leaf`` rows on
either side is a leaf.

The trees themselves, at most two to the ``max_depth`` nodes each, are the only thing
that passes through the driver; rows carry their places along in written tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.staging import stage

_DIGITS = 12
_NODES = (
    "tree int, node bigint, depth int, n bigint, n_true bigint, id bigint, at bigint, gain double"
)


@dataclass
class Node:
    """Of a split: the path, the least count that goes right, and the gain."""

    tree: int
    node: int  # the root is 1, the children of k are 2 k and 2 k + 1
    depth: int
    n: int
    n_true: int
    id: int | None = None
    at: int | None = None
    gain: float | None = None


@dataclass
class Trees:
    """``rows`` carry ``slots``: per tree, the leaf they ended in, as -1 minus its place."""

    folds: list[int]
    rows: DataFrame
    nodes: list[Node] = field(default_factory=list)
    leaves: list[list[Node]] = field(default_factory=list)

    def table(self) -> DataFrame:
        """All nodes: ``tree, node, depth, n, n_true``, and ``id, at, gain`` of splits."""
        rows = [(n.tree, n.node, n.depth, n.n, n.n_true, n.id, n.at, n.gain) for n in self.nodes]
        return self.rows.sparkSession.createDataFrame(rows, _NODES)

    def predictions(self) -> DataFrame:
        """``a, b, label, fold, score, prediction`` of the tree that did not see the row."""
        shares = [[n.n_true / n.n if n.n else 0.0 for n in own] for own in self.leaves]
        known = self.rows.sparkSession.createDataFrame([(shares,)], "_s array<array<double>>")
        tree = F.array_position(F.lit(self.folds), F.col("fold")).cast("int") - 1
        slot = -1 - F.get("slots", tree)
        scored = self.rows.select("a", "b", "label", "fold", tree.alias("_t"), slot.alias("_k"))
        score = F.get(F.get(known.scalar(), F.col("_t")), F.col("_k"))
        return scored.select(
            "a", "b", "label", "fold", score.alias("score"), (score > 0.5).alias("prediction")
        )


def _plogp(n: Column) -> Column:
    return F.when(n > 0, n * F.log2(n.cast("double"))).otherwise(0.0)


def _spread(n: Column, n_true: Column) -> Column:
    """n times the entropy of a node."""
    return _plogp(n) - _plogp(n_true) - _plogp(n - n_true)


def histograms(rows: DataFrame, folds: list[int]) -> DataFrame:
    """``tree, slot, id, n, rows, true``: rows of the open nodes by their count of a path."""
    trees = F.lit(folds)
    # A row's own tree must not learn from it, and closed nodes need not be told apart.
    learnt = F.transform(
        "slots", lambda s, t: F.when(F.get(trees, t) == F.col("fold"), -1).otherwise(F.greatest(s, F.lit(-1)))
    )
    open_ = rows.select("fold", "label", "cells", learnt.alias("slots")).where(
        F.exists("slots", lambda s: s >= 0)
    )
    counted = (
        open_.select("slots", "label", F.inline("cells"))
        .groupBy("slots", "id", "n")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if("label").alias("true"))
    )
    dealt = counted.select(F.posexplode("slots").alias("tree", "slot"), "id", "n", "rows", "true")
    return (
        dealt.where(F.col("slot") >= 0)
        .groupBy("tree", "slot", "id", "n")
        .agg(F.sum("rows").alias("rows"), F.sum("true").alias("true"))
    )


def best_splits(counts: DataFrame, totals: DataFrame, min_leaf: int) -> DataFrame:
    """``tree, slot, id, at, gain, rows, true`` of the best split of each node that has one;
    the last two are those of its right side."""
    down = W.partitionBy("tree", "slot", "id").orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, 0)
    right = counts.select(
        "tree", "slot", "id", F.col("n").alias("at"),
        F.sum("rows").over(down).alias("rows"), F.sum("true").over(down).alias("true"),
    )
    n, t, rows, true = (F.col(c) for c in ("total", "total_true", "rows", "true"))
    left, left_true = n - rows, t - true
    gain = (_spread(n, t) - _spread(rows, true) - _spread(left, left_true)) / n
    candidates = right.join(totals, ["tree", "slot"]).withColumn("gain", F.round(gain, _DIGITS))
    fitting = candidates.where((rows >= min_leaf) & (left >= min_leaf) & (F.col("gain") > 0))
    best = F.min(F.struct((-F.col("gain")).alias("less"), "id", "at", "rows", "true")).alias("s")
    return fitting.groupBy("tree", "slot").agg(best).select(
        "tree", "slot", "s.id", "s.at", (-F.col("s.less")).alias("gain"), "s.rows", "s.true"
    )


def _moved(rows: DataFrame, level: list[list[tuple]]) -> DataFrame:
    """Rows with the places they have after the splits of one level."""
    spark = rows.sparkSession
    kind = "_l array<array<struct<id:bigint,at:bigint,left:int,right:int>>>"
    known = spark.createDataFrame([(level,)], kind)

    def step(slot: Column, nodes: Column) -> Column:
        split = F.get(nodes, slot)
        held = F.get(F.filter("cells", lambda c: c["id"] == split["id"]), F.lit(0))["n"]
        right = F.coalesce(held, F.lit(0)) >= split["at"]
        return F.when(slot < 0, slot).when(right, split["right"]).otherwise(split["left"])

    moved = rows.withColumn("_l", known.scalar()).withColumn("slots", F.zip_with("slots", "_l", step))
    return moved.drop("_l")


def grow_trees(
    vectors: DataFrame, folds: list[int], max_depth: int = 10, min_leaf: int = 2
) -> Trees:
    """Trees for ``folds`` of the vectors ``a, b, label, fold, cells``; of a fold that no
    row has, the tree is grown from all rows."""
    if max_depth < 0 or min_leaf < 1:
        raise ValueError("max_depth must be at least 0 and min_leaf at least 1")
    sizes = vectors.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.count_if("label").alias("t"))
    own = {r.fold: (r.n, r.t) for r in sizes.collect()}
    n, t = (sum(x[i] for x in own.values()) for i in (0, 1))
    less = lambda f, i: own.get(f, (0, 0))[i]
    trees = Trees(folds, vectors.withColumn("slots", F.lit([0] * len(folds)).cast("array<int>")))
    trees.leaves = [[] for _ in folds]
    opened = [[Node(f, 1, 0, n - less(f, 0), t - less(f, 1))] for f in folds]
    trees.nodes = [x for own in opened for x in own]
    depth = 0
    while any(opened):
        found = _splits(trees, opened, min_leaf) if depth < max_depth else {}
        level, after = [], []
        for k, nodes in enumerate(opened):
            after.append([])
            level.append([_divide(trees, k, x, found.get((k, s)), min_leaf, after[k]) for s, x in enumerate(nodes)])
        trees.rows = stage(_moved(trees.rows, level), f"trees-{depth}")
        opened, depth = after, depth + 1
    return trees


def _splits(trees: Trees, opened: list[list[Node]], min_leaf: int) -> dict:
    totals = [(k, s, x.n, x.n_true) for k, own in enumerate(opened) for s, x in enumerate(own)]
    known = trees.rows.sparkSession.createDataFrame(
        totals, "tree int, slot int, total bigint, total_true bigint"
    )
    counts = histograms(trees.rows, trees.folds)
    return {(r.tree, r.slot): r for r in best_splits(counts, known, min_leaf).collect()}


def _divide(trees: Trees, k: int, node: Node, split, min_leaf: int, after: list[Node]) -> tuple:
    """What rows of a node are to do next; its children are opened or closed."""
    if split is None:
        return (None, None, _closed(trees, k, node), None)
    node.id, node.at, node.gain = split.id, split.at, split.gain
    depth = node.depth + 1
    left = Node(node.tree, 2 * node.node, depth, node.n - split.rows, node.n_true - split.true)
    right = Node(node.tree, 2 * node.node + 1, depth, split.rows, split.true)
    places = []
    for child in (left, right):
        trees.nodes.append(child)
        if child.n_true in (0, child.n) or child.n < 2 * min_leaf:
            places.append(_closed(trees, k, child))
        else:
            after.append(child)
            places.append(len(after) - 1)
    return (split.id, split.at, *places)


def _closed(trees: Trees, k: int, leaf: Node) -> int:
    trees.leaves[k].append(leaf)
    return -len(trees.leaves[k])

"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import cut_lineage, written


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `edges` (a, b), component being the smallest node reachable.

    Each round takes the smallest label among a node's neighbours and then the label of that label, so that labels
    travel along chains at doubling distance. Only joins and partially aggregated minima are used: a node of any degree
    is never gathered into one task. Rounds end when no label changes. Self-loops are allowed; nodes are not null.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.where(F.col("a") != F.col("b")).distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")))
    before = None if both.isEmpty() else _total(labels)
    for _ in range(max_rounds):
        if before is None:
            return labels
        near = both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("seen")), "b")
        offers = near.select(F.col("a").alias("node"), F.col("seen").alias("component")).union(labels)
        lowest = offers.groupBy("node").agg(F.min("component").alias("component"))
        beyond = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        after = lowest.join(beyond, "component", "left")
        labels = written(after.select("node", F.least("component", F.coalesce("further", "component")).alias("component")))
        total = _total(labels)
        before = None if total == before else total  # labels only fall, so an equal sum means that none changed
    if before is None:
        return labels
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")


def _total(labels: DataFrame):
    return labels.agg(F.sum(F.col("component").cast("decimal(38,0)")).alias("s")).first()["s"]


def ties_by_id(members: DataFrame, id_col: str, key_col: str, classes: DataFrame) -> DataFrame:
    """(a, b): pairs of `classes` (key_col, cls) that are tied because one id of `members` (id_col, key_col) is in both.

    Each id ties its other classes to the one of the smallest key, so a hot id gives no more pairs than it has classes.
    """
    first = members.groupBy(id_col).agg(F.min(key_col).alias("_first"), F.max(key_col).alias("_last")).where("_first <> _last").drop("_last")
    first = cut_lineage(first)
    if first.isEmpty():
        return classes.select(F.col("cls").alias("a"), F.col("cls").alias("b")).limit(0)
    pairs = members.select(id_col, key_col).join(first, id_col).where(F.col(key_col) != F.col("_first")).select("_first", key_col).distinct()
    one = classes.select(F.col(key_col).alias("_first"), F.col("cls").alias("a"))
    two = classes.select(key_col, F.col("cls").alias("b"))
    return cut_lineage(pairs.join(one, "_first").join(two, key_col).select("a", "b"))

"""Connected components of an edge table: label propagation with pointer jumping, all in Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ._scratch import Scratch
from ._skew import join_counted


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node of its component.

    Each round takes the smallest label among a node's neighbours and then the label of that label. It ends when no
    label changes. Tables of every round are written to the shared folder; nothing but a count reaches the driver.
    """
    both = scratch.save("edges", edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = scratch.save("labels-0", both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"))
    n = 0
    while True:
        n += 1
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
        lowered = scratch.save(
            f"near-{n}",
            labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("root")),
        )
        # a giant component has one root for very many nodes
        sizes = lowered.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
        jumps = scratch.save(f"jumps-{n}", lowered.select(F.col("node").alias("root"), F.col("root").alias("jump")).join(sizes, "root"))
        jumped = join_counted(lowered, jumps, ["root"], lowered.count(), ["node"])
        labels = scratch.save(f"labels-{n}", jumped.select("node", "was", F.col("jump").alias("root")))
        changed = labels.where("root != was").limit(1).count()
        labels = labels.select("node", "root")
        scratch.drop(f"near-{n}", f"jumps-{n}", f"labels-{n - 1}")
        if not changed:
            return labels

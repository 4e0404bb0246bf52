"""Connected components of an edge table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.llm.common import checkpoint


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``: root is the smallest node of
    its component.

    Each round hooks every node to its smallest neighbour (a map-side combined
    minimum), follows the hooks to their ends by pointer jumping, and contracts
    the edges to those ends; what is left shrinks quickly.  Nothing is gathered
    on the driver.  Null ends and loops are ignored; repeated edges count once.
    """
    e = checkpoint(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
                   .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    label = e.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    first = True
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = checkpoint(both.groupBy("a").agg(F.min("b").alias("m"))
                          .select(F.col("a").alias("v"), F.least("a", "m").alias("p")))
        while True:
            up = hook.select(F.col("v").alias("p"), F.col("p").alias("q"))
            jumped = checkpoint(hook.join(up, "p").select("v", "p", "q"))
            done = jumped.where("p <> q").isEmpty()
            hook = jumped.select("v", F.col("q").alias("p"))
            if done:
                break
        if first:
            label, first = hook.select(F.col("v").alias("node"), F.col("p").alias("root")), False
        else:
            label = checkpoint(label.join(hook.select(F.col("v").alias("root"), "p"), "root", "left")
                               .select("node", F.coalesce("p", "root").alias("root")))
        ends = hook.select(F.col("v").alias("a"), F.col("p").alias("pa"))
        e = checkpoint(e.join(ends, "a").join(ends.select(F.col("a").alias("b"), F.col("pa").alias("pb")), "b")
                       .where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
    return label

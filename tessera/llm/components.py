"""Connected components of a link table by repeated contraction, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import drop_path, materialise


def connected(links: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): nodes joined by links have the same root, their smallest node.

    Each round points every node at the smallest of itself and its neighbours, follows the pointers twice, and keeps the
    links between different roots.  The longest path of links shrinks by a factor in each round, so few rounds do.
    Self-links and repeated links change nothing; an empty table gives no rows.
    """
    edges = materialise(links.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    found = materialise(links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("root", F.col("node")), "roots")
    for _ in range(rounds):
        if edges.isEmpty():
            return found
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("to")), "pointers")
        for _ in range(2):
            after = to.select(F.col("a").alias("to"), F.col("to").alias("further"))
            to = to.join(after, "to", "left").select("a", F.coalesce("further", "to").alias("to"))
        to = materialise(to, "pointers")
        old = found
        found = materialise(
            old.join(to.withColumnRenamed("a", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots"
        )
        left, right = to.select("a", F.col("to").alias("ra")), to.select(F.col("a").alias("b"), F.col("to").alias("rb"))
        moved = edges.join(left, "a").join(right, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct()
        before, edges = edges, materialise(moved, "edges")
        drop_path(before)
        drop_path(old)
    raise RuntimeError("the components did not settle")

"""Connected components by minimum labels and pointer jumping, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressroom.llm.common import is_empty, salted_join, save


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; a component is named by its least node.

    Loops, repeated edges and either direction are allowed; nulls are dropped; no edges give no
    rows. Hubs are joined with salt and minima are taken before the shuffle. A chain of n nodes
    needs about log2(n) rounds; ``RuntimeError`` if ``max_rounds`` do not do.
    """
    edges = edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = save(both.distinct(), "edges")
    labels = save(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    for _ in range(max_rounds):
        seen = salted_join(both, labels.select(F.col("node").alias("a"), "label"), ["a"], by="b")
        least = seen.groupBy(F.col("b").alias("node")).agg(F.min("label").alias("near"))
        one = labels.join(least, "node", "left").select(
            "node", F.col("label").alias("before"), F.least("label", "near").alias("label")
        )
        one = save(one, "labels")
        jump = one.select(F.col("node").alias("label"), F.col("label").alias("root"))
        two = salted_join(one, jump, ["label"], by="node").select("node", "before", F.col("root").alias("label"))
        two = save(two, "labels")
        labels = two.select("node", "label")
        if is_empty(two.filter(F.col("before") != F.col("label"))):
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

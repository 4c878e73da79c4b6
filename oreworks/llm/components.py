"""Connected components by repeated contraction, all in DataFrame joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from oreworks import scratch


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node with an edge.

    ``edges`` has columns a and b of one orderable type; direction, repeats, self-loops and
    nulls do not matter. Each round points every node at its smallest neighbour, follows the
    pointers once more, and keeps only edges between different targets. At least half
    of the nodes vanish per round. The smallest node of a component is always its own target, so it
    ends as the root. Rounds are written to the shared folder, which keeps plans short and
    survives lost executors. A hub's edges are combined in each task before the shuffle.
    """
    spark = edges.sparkSession

    def stage(df: DataFrame) -> DataFrame:
        return scratch.stage(df, scratch.new_path(spark, label))

    edges = stage(edges.select("a", "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    kind = edges.schema["a"].dataType
    known = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        target = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("target"))
        target = stage(target)
        onward = target.select(F.col("node").alias("target"), F.col("target").alias("onward"))
        target = stage(target.join(onward, "target").select("node", F.col("onward").alias("target")))
        if known is None:
            known = target.withColumnRenamed("target", "root")
        else:
            moved = known.join(target.withColumnRenamed("node", "root"), "root", "left")
            known = stage(moved.select("node", F.coalesce("target", "root").alias("root")))
        a = target.select(F.col("node").alias("a"), F.col("target").alias("to_a"))
        b = target.select(F.col("node").alias("b"), F.col("target").alias("to_b"))
        moved = edges.join(a, "a").join(b, "b").where("to_a <> to_b")
        edges = stage(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct())
    if known is None:
        return spark.createDataFrame([], f"node {kind.simpleString()}, root {kind.simpleString()}")
    return known

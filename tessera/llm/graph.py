"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.storage import drop, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): root is the least node reachable; only nodes that have an edge.

    Every round each node takes the least label of its neighbours, then the label of its label. Labels are per node and
    edges per pair, both partially aggregated; nothing is collected, and each round's labels are stored in place of the last one's.
    """
    spark = edges.sparkSession
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both, at_edges = written(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "component-edges")
    labels, at = written(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("root")).withColumnRenamed("x", "node"), "component-labels")
    while True:
        near = both.join(labels, both["y"] == labels["node"]).groupBy("x").agg(F.min("root").alias("near"))
        step = labels.join(near, labels["node"] == near["x"]).select("node", "root", F.least("root", "near").alias("low"))
        up = labels.select(F.col("node").alias("up_node"), F.col("root").alias("up"))
        step = step.join(up, F.col("low") == F.col("up_node"), "left").select("node", "root", F.least("low", F.coalesce("up", "low")).alias("next"))
        step, following = written(step, "component-labels")
        changed = step.where("root <> next").limit(1).count()
        drop(spark, at)
        at, labels = following, step.select("node", F.col("next").alias("root"))
        if not changed:
            drop(spark, at_edges)
            return labels

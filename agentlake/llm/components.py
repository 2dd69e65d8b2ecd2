"""Connected components of an edge table, by Spark jobs only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.llm.storage import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b: BIGINT, not null).

    Each round takes the smallest label among a node's neighbours and then the label of that label, which halves the
    distance to the smallest node; rounds end when nothing changes. Labels are written after each round, so that
    neither lineage nor plan grows and a lost executor costs one round at most. No edges give no rows.
    """
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = step.select(F.col("node").alias("component"), F.col("component").alias("next"))
        moved = materialize(step.join(jump, "component", "left").select("node", "old", F.coalesce("next", "component").alias("component")), "labels")
        if not moved.where("old <> component").limit(1).count():
            return moved.select("node", "component")
        labels = moved.select("node", "component")

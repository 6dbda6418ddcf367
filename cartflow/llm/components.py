"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for the nodes of ``edges`` (a, b).

    Every node takes the least label among its neighbours and itself, then labels are
    followed one step (label of the label), until nothing changes; paths shrink by half a
    round or faster. Minima are combined before the shuffle, and both sides of each join
    are stored tables, so a hub with many edges is split by adaptive execution.
    """
    ends = edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "other")
    both = materialise(ends.union(ends.select("node", F.col("node").alias("other"))).distinct())
    labels = materialise(both.groupBy("node").agg(F.min("other").alias("root")))
    state = None
    while True:
        now = labels.agg(F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()[0]
        if now == state:
            return labels
        state = now
        lowered = materialise(both.join(labels.withColumnRenamed("node", "other"), "other")
                              .groupBy("node").agg(F.min("root").alias("root")))
        of_root = lowered.select(F.col("node").alias("root"), F.col("root").alias("next"))
        labels = materialise(lowered.join(of_root, "root").select("node", F.col("next").alias("root")))


def merged(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """``roots`` (node, root) after the edges (a, b) between its nodes; only classes that meet are labelled anew."""
    one = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    two = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    meeting = materialise(edges.join(one, "a").join(two, "b").where("root_a != root_b").select(
        F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct())
    if not meeting.limit(1).count():
        return roots
    changed = components(meeting).select(F.col("node").alias("root"), F.col("root").alias("now"))
    return materialise(roots.join(changed, "root", "left").select("node", F.coalesce("now", "root").alias("root")))

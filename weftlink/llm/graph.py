"""Connected components by contraction: hook every root to its least neighbour, then jump."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.llm.common import Workspace


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """(node, label) for every node of edges(a, b): label is the least node of its component.

    In each round every root that has a smaller neighbour is hooked to its least one and
    chains of hooks are followed to their ends, so the least node of any neighbourhood takes
    it over; a star with the greatest node in its middle takes two rounds. No step gathers
    a component: minima are combined before shuffling, and edges join labels by key.
    """
    live = work.save(edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).where("low < high").distinct(), "edges")
    first = live
    labels = None
    while not live.isEmpty():
        parent = work.save(live.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("label")), "parents")
        while True:  # every root points to a smaller one; follow the pointers to the end
            up = parent.select(F.col("node").alias("label"), F.col("label").alias("above"))
            jumped = work.save(parent.join(up, "label", "left").select("node", F.coalesce("above", "label").alias("label"), F.col("above").isNotNull().alias("moved")), "jumped")
            moved = not jumped.where("moved").isEmpty()
            work.drop(parent)
            parent = jumped
            if not moved:
                break
        parent = parent.select("node", "label")
        if labels is None:
            own = first.select(F.col("low").alias("node")).union(first.select(F.col("high").alias("node"))).distinct()
            labels = own.withColumn("label", F.col("node"))
        up = parent.select(F.col("node").alias("label"), F.col("label").alias("above"))
        labels = work.save(labels.join(up, "label", "left").select("node", F.coalesce("above", "label").alias("label")), "labels")
        for end in ("low", "high"):
            up = parent.select(F.col("node").alias(end), F.col("label").alias("above"))
            live = live.join(up, end, "left").withColumn(end, F.coalesce("above", end)).drop("above")
        live = work.save(live.select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high")).where("low < high").distinct(), "edges")
    if labels is None:
        labels = first.select(F.col("low").alias("node"), F.col("low").alias("label"))
    return labels

"""Connected components of an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.scratch import cut


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of edges (a, b); the component is its smallest node.

    Nodes take the least label of their neighbours, then the label of that label,
    until nothing changes; the jumps halve long chains. Each round is written to the
    scratch folder. Rounds combine labels on the map side, so a node with many
    neighbours does not meet them all in one task.
    """
    edges = edges.filter(F.col("a") != F.col("b"))
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    changed = not labels.isEmpty()
    while changed:
        # What a node offers goes to its neighbours and to the node that is its label now.
        offers = both.join(labels, both.a == labels.node).select(F.col("b").alias("node"), "component")
        to_label = labels.withColumn("to", F.col("component")).alias("x").join(
            offers.groupBy("node").agg(F.min("component").alias("offer")).alias("o"), F.col("x.node") == F.col("o.node")
        )
        lower = to_label.select(F.col("x.node").alias("node"), F.least("component", "offer").alias("component"), "to")
        hooked = lower.select(F.col("to").alias("node"), "component").union(lower.select("node", "component"))
        merged = cut(hooked.groupBy("node").agg(F.min("component").alias("component")), "labels")
        jump = merged.select(F.col("node").alias("at"), F.col("component").alias("next"))
        jumped = merged.join(jump, merged.component == jump["at"]).select("node", F.col("next").alias("component"))
        after = cut(jumped, "labels")
        before = labels.withColumnRenamed("component", "old")
        changed = not after.join(before, "node").filter(F.col("component") != F.col("old")).isEmpty()
        labels = after
    return labels

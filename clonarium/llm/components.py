"""Connected components of a link table, with hash partitioned joins only.

Each round every node takes the least label among itself and its neighbours, and labels are
then followed to their own labels (pointer jumping), so chains shorten at least by half. Every
round is a written table. Rounds end when no label changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clonarium.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable; ``links`` has long columns ``a`` and ``b``.

    Nodes without links do not occur in the result. A link may be given any number of times
    and in either direction.
    """
    pairs = links.where("a <> b")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Hub and spoke: a hot node's links are combined map side by every groupBy below.
    edges = materialize(both.distinct(), "links")
    labels = materialize(edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), "labels")
    while True:
        near = edges.join(labels, edges.b == labels.node).select("a", "component")
        least = near.groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(least, "node").select("node", F.least("component", "near").alias("mid"))
        lower = materialize(lower, "lower")
        jump = lower.select(F.col("node").alias("mid"), F.col("mid").alias("far"))
        new = materialize(
            lower.join(jump, "mid").select("node", F.least("mid", "far").alias("component")), "labels"
        )
        changed = new.join(labels.withColumnRenamed("component", "old"), "node").where("component <> old")
        if changed.isEmpty():
            return new
        labels = new

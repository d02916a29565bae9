"""Connected components of any number of links, by contraction; nothing of them passes the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import small_side, written


def connected_components(links: DataFrame) -> DataFrame:
    """node, label: the label of a component is one of its nodes. ``links`` has columns a and b of one type, not null.

    In each round every node is merged into its smallest neighbour (or stays if it is smaller), and links are redrawn
    between what remains, so at least half of the nodes that still have links go. Nodes without links have no row.
    Repeated links do no harm. The labels are broadcast by joins if they are few (:func:`small_side`).
    """
    edges = written(links.filter("a <> b").select("a", "b"), "links")
    steps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = small_side(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")), "parents")
        steps.append(parents)
        left = edges.join(parents, "a").select(F.col("p").alias("x"), "b")
        redrawn = left.join(parents.withColumnRenamed("p", "y"), left.b == parents.a).select(F.col("x").alias("a"), F.col("y").alias("b"))
        ordered = redrawn.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges = written(ordered.distinct(), "links")
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label")).limit(0)
    labels = steps[0].select(F.col("a").alias("node"), F.col("p").alias("label"))
    for step in steps[1:]:
        onward = step.select(F.col("a").alias("label"), "p")
        labels = labels.join(onward, "label", "left").select("node", F.coalesce("p", "label").alias("label"))
    return small_side(labels, "components") if len(steps) > 1 else labels

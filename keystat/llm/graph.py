"""Connected components of a graph given as edges, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystat.llm.common import counted, materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the smallest node reachable.

    Every round takes the least label among the neighbours and then the label
    of the label, until nothing changes; star-like graphs need two or three.
    Each round is written, so lineage stays short; nothing is collected.
    """
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = materialise(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        .select("node", F.least("node", "b").alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("least")))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "least").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("further"))
        moved, changed = counted(
            lower.join(jump, "next").select("node", F.least("next", "further").alias("label"),
                                            (F.least("next", "further") < F.col("label")).alias("moved")), "labels", F.col("moved"))
        labels = moved.select("node", "label")
        if not changed:
            return labels

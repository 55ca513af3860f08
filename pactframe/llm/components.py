"""Connected components of an edge table by spreading smallest labels and jumping over labels of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactframe.llm.common import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node reachable) of every node in edges (a, b); each round is written and read again.

    The rounds grow with the logarithm of the longest path. A node with very many edges is no harm: minima are taken
    before rows are shuffled. No edges: no rows.
    """
    both = stage(
        edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        .select("e.a", "e.b")
        .distinct(),
        "links",
    )
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        met = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        above = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        new = stage(met.join(above, "label").select("node", "old", F.least("label", "above").alias("label")), "labels")
        labels = new.select("node", "label")
        if new.filter("label < old").limit(1).count() == 0:
            return labels

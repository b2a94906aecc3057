"""Connected components of an undirected graph as repeated joins; nothing is gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm._runtime import stored


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)``, both ways or one, to ``(id, label)``: the smallest id that each end can reach.

    Each round takes the smallest label of a node and its neighbours, then the label of that label. Long paths halve each round and
    stars end in two. Hot nodes are pre-aggregated, and their joins are split by adaptive execution. Empty edges give no rows.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        step = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        far = labels.select(F.col("id").alias("mid"), F.col("label").alias("far"))
        new = stored(step.join(far, "mid").select("id", "old", F.least("mid", "far").alias("label")), "labels")
        if new.where("old <> label").isEmpty():
            return new.select("id", "label")
        labels = new.select("id", "label")

"""Connected components of a large graph as a short loop of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripaudit.llm.tables import written


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) with the smallest node of every component as label, for the nodes of
    ``edges`` (a, b).  Labels spread to neighbours and are followed to their own label in
    every round, so the number of rounds grows with the logarithm of long chains; each
    round is written to the shared folder."""
    both = written(edges.select("a", "b").where("a <> b").union(edges.select("b", "a").where("a <> b"))
                   .toDF("node", "other").distinct(), f"{name}-edges")
    labels = written(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), name)
    while True:
        near = (both.join(labels.toDF("other", "_near"), "other").groupBy("node").agg(F.min("_near").alias("_near")))
        spread = labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                  F.least("label", "_near").alias("label"))
        own = labels.toDF("label", "_own")
        step = written(spread.join(own, "label", "left")
                       .select("node", "old", F.least("label", F.coalesce("_own", "label")).alias("label")), name)
        labels = step.select("node", "label")
        if step.where("label <> old").isEmpty():
            return labels

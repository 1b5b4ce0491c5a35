"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.scratch import keep


def components(links: DataFrame) -> DataFrame:
    """node and component, its smallest node, for every node of the links (columns a, b).

    Each round a node takes the smallest label around it and then that label's own label, so the number of
    rounds grows with the logarithm of the longest path. A round is a written table; only whether
    anything changed comes to the driver.
    """
    links = links.select("a", "b").filter("a != b")
    both = keep(links.union(links.select("b", "a")).distinct(), "links")
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("before"), F.least("label", "near").alias("label"))
        own = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        step = keep(step.join(own, "label").select("node", "before", F.least("label", "next").alias("label")), "labels")
        labels = step.select("node", "label")
        if step.filter("before != label").isEmpty():
            return labels.withColumnRenamed("label", "component")

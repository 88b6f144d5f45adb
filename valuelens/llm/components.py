"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """node, component: the smallest node that can be reached, for every node that has a link (a, b).

    Every round takes the least label of all neighbours, summed before the shuffle, and then the label of the label,
    so that long chains shrink fast. Rounds are written to the shared folder; the driver learns only whether
    anything changed. No links: no rows.
    """
    both = written(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(),
        "links",
    )
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("label")),
        "labels",
    )
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("least"))
        )
        lower = labels.join(near, labels["node"] == near["a"], "left").select(
            "node", F.col("label").alias("before"), F.least("label", "least").alias("label")
        )
        further = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        following = written(
            lower.join(further, "label", "left").select("node", "before", F.least("label", "next").alias("label")), "labels"
        )
        labels = following.select("node", "label")
        if following.where("before <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")

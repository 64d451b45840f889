"""Connected components of a graph that is a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempestry.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of every node of ``links`` (``a, b``): the smallest node that links lead to.

    Each round takes the smallest label of a node's neighbours and then the
    label of that label, so that labels travel twice as far from round to
    round. Rounds are written to the shared folder; only the number of labels
    that changed reaches the driver.
    """
    both = saved(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        nearer = saved(
            labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")), "labels-near"
        )
        over = nearer.select(F.col("node").alias("label"), F.col("label").alias("far"))
        stepped = saved(nearer.join(over, "label").select("node", "old", F.least("label", "far").alias("label")), "labels")
        labels = stepped.drop("old")
        if not stepped.where("label <> old").count():
            return labels

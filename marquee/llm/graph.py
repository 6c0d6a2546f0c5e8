"""Connected components by DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """Label the nodes of undirected ``edges`` (grp, a, b) by the least node they reach.

    Returns (grp, node, label); nodes of different ``grp`` are different nodes. Each round takes the least
    label among neighbours and then the label of that label, so a path is halved. Every round is written to
    the checkpoint folder; the driver gets one number a round. Empty edges give an empty frame. Nodes must
    not be null.
    """
    both = edges.select("grp", "a", "b").union(edges.select("grp", F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut_lineage(both.filter("a <> b").distinct())
    labels = cut_lineage(both.groupBy("grp", F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")))
    while True:
        near = both.join(labels.select("grp", F.col("node").alias("b"), "label"), ["grp", "b"])
        near = near.groupBy("grp", F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hooked = labels.join(near, ["grp", "node"], "left").select("grp", "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # a node whose label moved tells its old label too, so whole trees move at once
        told = hooked.filter("label < old").groupBy("grp", F.col("old").alias("node")).agg(F.min("label").alias("told"))
        hooked = hooked.join(told, ["grp", "node"], "left").select("grp", "node", "old", F.least("label", "told").alias("label"))
        hooked = cut_lineage(hooked)
        jump = hooked.select("grp", F.col("node").alias("label"), F.col("label").alias("next"))
        after = hooked.join(jump, ["grp", "label"], "left").select("grp", "node", F.least("label", "next").alias("label"), "old")
        after = cut_lineage(after)
        if after.filter("label <> old").limit(1).count() == 0:
            return after.select("grp", "node", "label")
        labels = after.select("grp", "node", "label")

"""Connected components by rounds of smallest-label spreading and label jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: for every node of a link the smallest node that links lead to.

    Each round gives a node the smallest label among its own and its
    neighbours', then the label of its label.  Rounds end when no label
    changes.  Each round is written out, so it survives lost executors; labels
    and links stay distributed, and only the number of changes reaches the driver.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    both = materialize(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(),
                       "links")
    labels = materialize(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
                         .select("node", F.least("node", "m").alias("root")), "labels")
    while True:
        near = (both.join(labels, both["v"] == labels["node"]).groupBy(F.col("u").alias("to"))
                .agg(F.min("root").alias("m")))
        spread = labels.join(near, labels["node"] == near["to"]).select(
            "node", F.col("root").alias("was"), F.least("root", "m").alias("root"))
        of = labels.select(F.col("node").alias("at"), F.col("root").alias("further"))
        jumped = materialize(spread.join(of, spread["root"] == of["at"], "left").select(
            "node", "was", F.least("root", F.coalesce("further", "root")).alias("root")), "labels")
        labels = jumped.select("node", "root")
        if not jumped.filter("was <> root").limit(1).count():
            return labels

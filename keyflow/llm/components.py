"""Connected components of a link table, as joins and aggregates.

Every node starts with its own label. A round gives it the smallest label among
its neighbours and itself, then follows the label's own label (pointer jumping),
so the number of rounds grows with the logarithm of the longest path. Labels
are written to the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for links (a, b); component is the smallest node reachable.

    Nodes without a link are not listed; repeated links and links of a node to
    itself do no harm; an empty table gives an empty result.
    """
    edges = materialize(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .filter("a <> b").distinct(), "component-links")
    labels = materialize(edges.groupBy(F.col("a").alias("node"))
                         .agg(F.least(F.col("a"), F.min("b")).alias("component")),
                         "component-labels")
    while True:
        near = (edges.join(labels, F.col("b") == F.col("node")).groupBy("a")
                .agg(F.min("component").alias("near")))
        step = (labels.join(near, F.col("node") == F.col("a"))
                .select("node", F.col("component").alias("was"),
                        F.least("component", "near").alias("next")))
        over = labels.select(F.col("node").alias("via"), F.col("component").alias("beyond"))
        after = materialize(
            step.join(over, F.col("next") == F.col("via"), "left")
            .select("node", "was", F.least("next", F.coalesce("beyond", "next"))
                    .alias("component")), "component-labels")
        labels = after.select("node", "component")
        if after.filter("was <> component").isEmpty():
            return labels

"""Connected components of links between documents, as iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.scratch import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node reachable) of every node of ``links`` (``a``, ``b``).

    Every round takes the smallest label among a node and its neighbours, then follows the label of the label,
    so long chains halve.  Each round is written to the shared folder; a hub is only a hot join key there, which
    adaptive execution splits, and minima combine before the shuffle.  Nothing but a count reaches the driver.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a <> b").distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
    labels = stored(labels.select("node", F.least("node", "b").alias("label")), "labels")
    while True:
        of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("_near"))
        near = both.join(of_b, "b").groupBy(F.col("a").alias("node")).agg(F.min("_near").alias("_near"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "_near").alias("_new"))
        of_label = step.select(F.col("node").alias("_new"), F.col("_new").alias("_next"))
        step = step.join(of_label, "_new", "left").select(
            "node",
            F.coalesce("_next", "_new").alias("label"),
            (F.col("label") != F.coalesce("_next", "_new")).alias("_moved"),
        )
        labels = stored(step, "labels")
        if labels.filter("_moved").limit(1).count() == 0:
            return labels.select("node", "label")

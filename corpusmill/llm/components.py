"""Connected components of a link table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every end of the links ``(a, b)``; ``label`` is the
    least node that the links reach.

    Each round takes the least label among a node's neighbours and then the label
    of that label, so chains shorten by more than half; a round's table is written
    to the shared checkpoint folder and the rounds end when nothing changes. Only
    the number of changes comes to the driver. Sums over neighbours combine before
    they are shuffled, so a node with very many links costs no task more than its
    own rows."""
    links = materialize(links.select("a", "b").filter("a <> b"), "links")
    both = links.union(links.select("b", "a")).toDF("node", "other")
    labels = materialize(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("now"))
        jump = labels.select(F.col("node").alias("now"), F.col("label").alias("far"))
        step = step.join(jump, "now").select("node", "label", F.least("now", "far").alias("now"))
        step = materialize(step, "labels")
        changed = step.filter("now <> label").limit(1).count()
        labels = step.select("node", F.col("now").alias("label"))
        if not changed:
            return labels

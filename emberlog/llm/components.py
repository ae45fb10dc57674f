"""Connected components of a graph given as edges, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.shared import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b); the label is the least node that can be reached.

    Each round takes the least label of a node's neighbours and then the label of that label, so the number of rounds
    follows the logarithm of the longest path. Rounds are written to the shared checkpoint folder; nothing but the number of
    changes reaches the driver. Loops and repeated edges do no harm; no edges give no rows; null ends are left out.
    """
    both = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = checkpointed(both.union(both.select("b", "a")).distinct())
    labels = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b")
        least = near.groupBy(F.col("a").alias("of")).agg(F.min("label").alias("found"))
        stepped = labels.join(least, F.col("node") == F.col("of")).select(
            "node", F.col("label").alias("was"), F.least("label", "found").alias("label")
        )
        beyond = labels.select(F.col("node").alias("at"), F.col("label").alias("beyond"))
        jumped = stepped.join(beyond, F.col("label") == F.col("at"), "left").select(
            "node", "was", F.least("label", F.coalesce("beyond", "label")).alias("label")
        )
        jumped = checkpointed(jumped)
        changed = not jumped.filter("was <> label").isEmpty()
        labels = jumped.select("node", "label")
        if not changed:
            return labels

"""Connected components of a link table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.exchange import stage


def components(links: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, label): the least node of each node's component; links: (a, b), in any direction.

    Every round takes the least label among neighbours, then the label of that
    label, so chains halve.  Tables are written between rounds; nothing but a
    count of changes reaches the driver.  Nodes without a link are absent; an
    empty link table gives an empty result."""
    both = stage(links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct())
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                   .select("node", F.least("node", "least").alias("label")))
    for _ in range(rounds):
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        better = stage(labels.join(near, "node").join(jump, "label", "left")
                       .select("node", F.least("label", "near", "far").alias("next"), "label"))
        done = better.where("next < label").isEmpty()
        labels = better.select("node", F.col("next").alias("label"))
        if done:
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")

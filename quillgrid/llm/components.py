"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written_table


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every end of a link; the component is the smallest id reachable.

    Labels move along the links and are then followed to the label of the label, so long chains
    shrink fast. Each round is written, so a lost executor repeats one round at most. The loop
    ends when a round changes nothing.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = written_table(pairs.union(pairs.select("v", "u")).distinct(), "links")
    labels = written_table(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("id"), F.least("u", "m").alias("component")), "labels")
    while True:
        heard = both.join(labels.withColumnRenamed("id", "v"), "v").groupBy("u").agg(F.min("component").alias("heard"))
        lower = labels.join(heard.withColumnRenamed("u", "id"), "id").select("id", "component", F.least("component", "heard").alias("next"))
        lower = written_table(lower, "labels")
        jump = lower.select(F.col("id").alias("next"), F.col("next").alias("jump"))
        moved = written_table(
            lower.join(jump, "next", "left").select("id", F.least("next", "jump").alias("to"), "component"), "labels"
        )
        labels = moved.select("id", F.col("to").alias("component"))
        if moved.where("to <> component").isEmpty():
            return labels

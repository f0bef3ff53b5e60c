"""Connected components of an edge list by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, tasks_for


#: edges, each in both directions, that a task takes
EDGES = 1 << 14


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """node, component: the smallest node that each node is connected to.

    Every round each node takes the smallest label among its neighbours and then the
    label of its label, so chains shorten geometrically.  Rounds are written to the shared
    folder; nothing but the number of changed labels reaches the driver.  Null ends are ignored.
    """
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).dropna()
    both = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    tasks = tasks_for(edges.sparkSession, both.count(), EDGES)
    labels = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label"))
                    .select(F.col("a").alias("node"), "label"), "cc-labels", tasks)
    while True:
        around = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
                  .withColumnRenamed("a", "node"))
        lower = labels.join(around, "node").select("node", F.col("label").alias("old"),
                                                   F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = stored(lower.join(jump, "label", "left")
                     .select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")),
                     "cc-labels", tasks)
        changed = new.filter(F.col("old") != F.col("label")).count()
        labels = new.select("node", "label")
        if not changed:
            return labels.select("node", F.col("label").alias("component"))

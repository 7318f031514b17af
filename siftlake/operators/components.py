"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.operators.lookup import salted_join
from siftlake.session import drop_stage, stage


def connected_components(nodes: DataFrame, edges: DataFrame, node: str, left: str, right: str) -> DataFrame:
    """One row ``(node, component)`` per node; ``component`` is the smallest node reached over undirected ``edges``.

    Each round a node takes the smallest label among its neighbours and itself, then the label of
    that label, so paths shorten by half or more.  Edges with a null end or with ends that are no nodes are ignored;
    a node without edges is its own component.  Minima are taken before shuffles, hot labels are salted.
    """
    a, b = F.col(left), F.col(right)
    both = edges.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(F.inline(F.array(F.struct(a.alias("n"), b.alias("m")), F.struct(b.alias("n"), a.alias("m"))))).distinct()
    both = stage(both, "edges")
    count = both.count()
    labels = stage(nodes.select(F.col(node).alias("n")).filter("n is not null").distinct().withColumn("l", F.col("n")).withColumn("moved", F.lit(False)), "labels")
    while count:
        heard = salted_join(both, labels.select(F.col("n").alias("m"), "l"), "m", "inner", count).groupBy("n").agg(F.min("l").alias("h"))
        lower = labels.select("n", "l").join(heard, "n", "left").select("n", F.least("l", F.coalesce("h", "l")).alias("p"), F.col("l").alias("was"))
        up = lower.select(F.col("n").alias("p"), F.col("p").alias("pp"))
        jumped = salted_join(lower, up, "p", "left", count).select("n", F.least("p", F.coalesce("pp", "p")).alias("l"), "was")
        moved = stage(jumped.select("n", "l", (F.col("l") != F.col("was")).alias("moved")), "labels")
        drop_stage(labels)
        labels = moved
        if not labels.filter("moved").limit(1).count():
            break
    return labels.select(F.col("n").alias("node"), F.col("l").alias("component"))

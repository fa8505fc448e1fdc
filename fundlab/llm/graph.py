"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlab.skew import BROADCAST_ROWS, join_unique, key_counts
from fundlab.storage import materialize, release


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (its least node) for the nodes of edges (a, b), which are not null.

    Each round a node takes the least label among its own, its neighbours' and its
    label's label, so labels also jump along their own chains: the rounds grow
    with the logarithm of the longest path. Minima are taken before the shuffle;
    a node with very many neighbours, and a label with very many nodes, is dealt
    to several tasks. Repeated edges and edges from a node to itself change
    nothing; no edges give no rows.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("at"))
    both = materialize(both.union(both.select("at", "node")).filter(F.col("node") != F.col("at")).distinct())
    first = both.groupBy("node").agg(F.min("at").alias("near")).select("node", F.least("node", "near").alias("label"))
    labels = materialize(first, n=F.count(F.lit(1)))
    rows = labels.seen["n"]  # the same in every round
    degrees = key_counts(both, ["at"]) if rows > BROADCAST_ROWS else None
    for _ in range(most_rounds if rows else 0):
        known = labels.select(F.col("node").alias("at"), F.col("label").alias("via"))
        near = join_unique(both, known, ["at"], counts=degrees, rows=rows).select("node", "via", F.lit(None).cast(labels.schema["label"].dataType).alias("label"))
        jump = join_unique(labels.select("node", "label", F.col("label").alias("at")), known, ["at"], rows=rows).select("node", "via", "label")
        least = near.union(jump).groupBy("node").agg(F.min("via").alias("via"), F.max("label").alias("label"))  # a label's label is never above it
        new = materialize(least.select("node", F.col("via").alias("label"), (F.col("via") != F.col("label")).alias("moved")), moved=F.count_if("moved"))
        release(labels)
        labels = new
        if not new.seen["moved"]:
            break
    else:
        if rows:
            raise RuntimeError("labels still moved after the last round")
    release(both)
    return labels.select("node", F.col("label").alias("component"))

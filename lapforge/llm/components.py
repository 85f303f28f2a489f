"""Connected components of a graph of pairs, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Rounds


def components(edges: DataFrame, keep: Rounds | None = None) -> DataFrame:
    """Smallest reachable vertex per vertex of ``edges`` (a, b): rows (v, root), one per vertex that has an edge.

    Every round takes the smallest label among the neighbours, then follows the label's own label (halving
    path lengths).  Minima are combined in the map tasks, joins on a vertex with very many neighbours are
    ordinary joins that AQE splits, and every round is written out, so a lost executor costs one round.
    """
    keep = keep or Rounds(edges.sparkSession)
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = keep.write(both.where("a <> b").distinct(), "edges")
    labels = keep.write(both.groupBy(F.col("a").alias("v")).agg(F.least("v", F.min("b")).alias("root")), "labels")
    while True:
        near = both.join(labels, both.b == labels.v).groupBy("a").agg(F.min("root").alias("near"))
        step = labels.join(near, labels.v == near.a).select(
            "v", F.col("root").alias("old"), F.least("root", "near").alias("mid")
        )
        up = labels.select(F.col("v").alias("mid"), F.col("root").alias("up"))
        step = keep.write(step.join(up, "mid").select("v", "old", F.least("mid", "up").alias("root")), "labels")
        labels = step.select("v", "root")
        if not step.where("root <> old").limit(1).count():
            return labels

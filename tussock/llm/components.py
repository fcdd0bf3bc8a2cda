"""Connected components of a graph given as an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import dropped, sided, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a long, b long); label: one node of the component.

    Each round every node joins the smallest of itself and its neighbours, and the edges
    are rewritten between what is left, until none joins two different nodes. A round keeps at
    most the nodes that have no smaller neighbour. No edges give no rows; loops and
    repeated edges are harmless. Edges and labels stay distributed; a round's moves are looked up by
    broadcast while they are few, and joined by key beyond that.
    """
    live = stored(edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = stored(nodes.withColumn("label", F.col("node")), "cc-labels")
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = stored(both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("v")).filter("v < u"), "cc-parent")
        parent, before = sided(moves), [live, labels, moves]
        labels = stored(labels.join(parent, F.col("label") == F.col("u"), "left")
                        .select("node", F.coalesce("v", "label").alias("label")), "cc-labels")
        p, q = parent, parent.select(F.col("u").alias("u2"), F.col("v").alias("v2"))
        moved = (live.join(p, F.col("a") == F.col("u"), "left").join(q, F.col("b") == F.col("u2"), "left")
                 .select(F.coalesce("v", "a").alias("a"), F.coalesce("v2", "b").alias("b")))
        live = stored(moved.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                      .distinct(), "cc-edges")
        dropped(*before)
    dropped(live)
    return labels

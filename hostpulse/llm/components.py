"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostpulse.llm.store import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie neighbours to the smallest node around; edges run from the larger end ``a`` to ``b``.

    A large star moves the larger neighbours of each node, a small star the
    smaller ones and the node itself. Both leave the components as they are.
    """
    down = edges.select(F.col("a").alias("hub"), F.col("b").alias("arm"))
    up = edges.select(F.col("b").alias("hub"), F.col("a").alias("arm"))
    around = down.union(up) if large else down
    least = around.groupBy("hub").agg(F.min("arm").alias("low"))
    least = written(least.select("hub", F.least("hub", "low").alias("low")))
    moved = up if large else down
    tied = moved.join(least, "hub").select(F.col("arm").alias("a"), F.col("low").alias("b"))
    if not large:
        tied = tied.union(least.select("hub", "low"))
    return written(tied.where("a <> b").distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for all ends of ``edges``.

    ``edges`` has two bigint columns ``a`` and ``b``; self-loops, repeats and
    either direction are fine, rows with a null are ignored, and no edges give
    no rows. Large and small stars alternate until nothing changes. Each star is
    a minimum per node, combined on the map side, and a join that can be split
    where a node has very many neighbours; every step is a written table. The
    driver sees a count and a checksum per round.
    """
    edges = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before, now = None, _mark(edges)
    while now[0] and now != before:
        edges = _star(_star(edges, large=True), large=False)
        before, now = now, _mark(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )

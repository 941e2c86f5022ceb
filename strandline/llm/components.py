"""Connected components of an edge table, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (longs ``a`` and ``b``); the component is its smallest node.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its smallest one, then its
    smaller neighbours. The edges never grow in number and end as stars around the smallest nodes, after a number of
    rounds that grows with the logarithm of the nodes. Minima aggregate before the shuffle; joins on a node with very
    many neighbours have that node once on the other side, so adaptive execution splits them. Every round is
    a written table, freed when its successor is there. Edges with a null end are left out; no edges give no rows.
    """
    table = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a is not null and b is not null and a <> b").distinct(), "edges")
    state = None
    while True:
        edges = table.rows
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        state = seen
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        handed = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        last, table = table, written(handed.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        last.free()

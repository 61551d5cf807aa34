"""Connected components of links between rows, by contraction.

In each round every node draws a number by a hash of its id and the round, and points at the one
with the least number among itself and its neighbours; links between nodes become links between
what they point at. So a constant share of the nodes goes in each round, whatever the ids and the
shape of the component (a chain of ascending ids included). Each round's tables are written to
the shared folder, so lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import scratch


def _kept(rows: DataFrame, name: str) -> DataFrame:
    path = scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) between long ids: node and component, one row per node that has a link.

    Nodes of one component share its number; which number it is has no meaning. Links of a node
    with itself and repeated links are allowed. No links give no rows.
    """
    edges = _kept(links.select("a", "b").where("a <> b").distinct(), "links")
    member = None
    turn = 0

    def drawn(node: str) -> Column:
        return F.struct(F.xxhash64(node, F.lit(turn)).alias("draw"), F.col(node).alias("id"))

    while not edges.isEmpty():
        turn += 1
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = both.groupBy("a").agg(F.min(drawn("b")).alias("to"))
        points = points.select(F.col("a").alias("node"), F.least(drawn("a"), "to")["id"].alias("to"))
        points = _kept(points, "points")
        if member is None:
            member = points.select("node", F.col("to").alias("component"))
        else:
            moved = points.select(F.col("node").alias("component"), "to")
            member = member.join(moved, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")
            )
        member = _kept(member, "components")
        left = points.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = points.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges = edges.join(left, "a").join(right, "b").where("x <> y")
        edges = edges.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges = _kept(edges.distinct(), "links")
    if member is None:
        return links.sparkSession.createDataFrame([], "node long, component long")
    return member

"""Connected components of a distributed edge list, in DataFrame operations only.

Each round links every node to the smallest neighbour that it knows (large star
and small star alternately), which keeps the number of edges and merges chains in
logarithmically many rounds.  Both steps find minima by partial aggregation and
join on the node, so a node with many edges is never gathered in one place.
Rounds end when the edges form stars: each node has either one edge, to its smallest,
or none but those of its members.  Nothing but this answer is sent to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, new_path, publish, remove


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # the key is computed anew so that both sides are shuffled for the join, whose large keys can then be split
    linked = both.join(least.select(F.when(F.col("u").isNotNull(), F.col("u")).alias("u"), "m"), "u")
    if large:
        return linked.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    own = least.where("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b"))
    return linked.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(own).distinct()


def components(edges: DataFrame, label: str = "components", kept: Scratch | None = None) -> DataFrame:
    """Rows (node, component) for all nodes with an edge; the component is its smallest node.

    ``edges`` has the columns a and b of one ordered type; null ends, loops and repeats count for nothing.
    The table that the result reads is left to ``kept``, if given, to be deleted.
    """
    spark = edges.sparkSession
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    path = None
    while True:
        last = path
        path = new_path(spark, label)
        now = publish(now, label, path)
        done = _stars(now)
        if last:
            remove(spark, last)
        if done:
            if kept:
                kept.paths.append(path)
            break
        now = _star(_star(now, True), False)
    found = now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    return found.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one edge to a smaller node, or only edges to larger ones."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("b").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
    bad = F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))
    return not ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).agg(bad.alias("bad")).first()["bad"]

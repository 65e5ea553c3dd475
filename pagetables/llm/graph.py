"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetables.llm.tables import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over undirected ``(u, v)``, u > v.  The minimum is an aggregate
    joined back, so a hub with many neighbours is combined map-side and its
    rows may be split by the skew join."""
    pairs = edges.select("u", "v")
    if large:
        pairs = pairs.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = pairs.groupBy("u").agg(F.min("v").alias("m"))
    out = pairs.join(low.select("u", F.least("u", "m").alias("m")), "u")
    if large:
        out = out.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Every node points to one other, which points nowhere: nothing is left to do."""
    out = edges.groupBy(F.col("u").alias("n")).agg(F.count("*").alias("c"), F.lit(0).alias("t"))
    into = edges.groupBy(F.col("v").alias("n")).agg(F.lit(0).cast("long").alias("c"), F.lit(1).alias("t"))
    both = out.unionByName(into).groupBy("n").agg(F.max("c").alias("c"), F.max("t").alias("t"))
    return not both.filter("c > 1 or (c > 0 and t > 0)").take(1)


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node with an edge in ``edges(u, v)``.

    ``label`` is the smallest node reachable.  Rounds are stored, so a plan
    never grows; on n nodes about log(n) rounds are needed.  No edges give no
    rows; self edges and repeated edges change nothing; null ends are ignored.
    """
    cur = stored(edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _is_forest_of_stars(cur):
        cur = stored(_star(_star(cur, True), False), "stars")
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .union(cur.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()))

"""Connected components by alternating large-star and small-star rounds.

Every round is two grouped minima and two joins over the edge list; edges
stay a table, and only the answer whether they form a star forest yet comes
to the driver.  The minima of the large star are written before their join,
so that adaptive execution can split the shuffle of a hub that holds a large
share of all edges; the small star's joins are by the smaller side's
neighbours, of which a node has few by then.  A round never has more edges
than the one before, so the first count says how many tasks all need; where
that is less than the shuffles' partitions, these are merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import counted, cut, tasks


def _is_star_forest(edges: DataFrame, parts: int) -> bool:
    """Whether every node hangs on one centre and no centre hangs on another."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    node = ends.groupBy("n").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return node.where("hangs > 1 or (hangs = 1 and holds = 1)").coalesce(parts).isEmpty()


def _round(edges: DataFrame, parts: int) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = cut(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).coalesce(parts))
    large = (both.where("v > u").join(least, "u").where("v <> m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(parts).distinct())
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = (large.join(low, "u").where("v <> m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return cut(moved.union(low).coalesce(parts).distinct().coalesce(parts))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(``node``, ``component``): each linked node but the smallest of its component, which
    names it.  Null ends and self links are ignored."""
    edges, n = counted(links.where(F.col(a) != F.col(b))
                       .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    parts = tasks(n)
    while not _is_star_forest(edges, parts):
        edges = _round(edges, parts)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))

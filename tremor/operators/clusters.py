"""Density clusters of events.

Events are counted per grid cell first, so a cell that holds a third of all
events is one row from then on.  A cell is *core* when its 3 x 3 neighbourhood
holds at least ``min_events``; core cells that touch (8 neighbours) belong to
one cluster; a cell next to a core cell is its *border*, the rest is *noise*.
Clusters are connected components over core cells.  Neighbourhoods do not
cross the antimeridian.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.operators.spatial import density_grid
from tremor.session import scratch_path


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "clusters")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def components(links: DataFrame) -> DataFrame:
    """``a, b`` links -> ``node, component`` (smallest node of the component).

    Alternating large and small stars: each round links every node's
    neighbours to the smallest of them, by two aggregates and joins over links;
    rounds grow with the logarithm of the longest path.  No group is collected.
    """
    links = _written(links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        links = _written(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                         .unionByName(least.select("a", F.col("m").alias("b")))
                         .where("a <> b").distinct())
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = now


def density_clusters(points: DataFrame, cell_deg: float, min_events: int, lon: str = "longitude",
                     lat: str = "latitude") -> DataFrame:
    """``lat_cell, lon_cell, n_events, role, cluster`` of every cell with events.

    ``cluster`` names the cluster by its smallest core cell (``lat:lon``); a
    border cell between clusters takes the smallest; noise has none.
    """
    cells = _written(density_grid(points, cell_deg, lon, lat).select(
        F.col("lat_cell").alias("y"), F.col("lon_cell").alias("x"), "n_events"))

    def shifted(df: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
        steps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in pairs])
        return df.withColumn("_s", F.explode(steps)) \
            .withColumns({"ny": F.col("y") + F.col("_s.dy"), "nx": F.col("x") + F.col("_s.dx")})
    around = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
    near = shifted(cells, around).groupBy("ny", "nx").agg(F.sum("n_events").alias("near"))
    # an id that sorts like (y, x)
    node = F.shiftleft(F.col("y"), 32) + F.col("x")
    core = _written(cells.join(near, (F.col("y") == F.col("ny")) & (F.col("x") == F.col("nx")))
                    .where(F.col("near") >= min_events).select("y", "x", node.alias("node")))
    other = core.select(F.col("y").alias("ny"), F.col("x").alias("nx"), F.col("node").alias("b"))
    links = shifted(core, [s for s in around if s > (0, 0)]).join(other, ["ny", "nx"]) \
        .select(F.col("node").alias("a"), "b")
    named = core.join(components(links), "node", "left") \
        .select("y", "x", F.coalesce("component", "node").alias("component"))
    names = core.select(F.col("node").alias("component"),
                        F.concat_ws(":", F.col("y"), F.col("x")).alias("cluster"))
    # core cells name themselves and, for the border, the cells around them
    best = shifted(named, around).groupBy("ny", "nx").agg(
        F.min("component").alias("nearby"),
        F.min(F.when((F.col("ny") == F.col("y")) & (F.col("nx") == F.col("x")), F.col("component")))
        .alias("own"))
    joined = cells.join(best, (F.col("y") == F.col("ny")) & (F.col("x") == F.col("nx")), "left")
    role = F.when(F.col("own").isNotNull(), "core").when(F.col("nearby").isNotNull(), "border") \
        .otherwise("noise")
    return (joined.withColumn("component", F.coalesce("own", "nearby")).join(names, "component", "left")
            .select(F.col("y").alias("lat_cell"), F.col("x").alias("lon_cell"),
                    F.col("n_events").cast("long").alias("n_events"), role.alias("role"), "cluster"))

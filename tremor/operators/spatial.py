"""Spatial left join of event points to county polygons.

Plan (all DataFrame operators, no Python UDF):

1. **Cell index** (built from the polygon edges only, so its size is bounded
   by the polygon input, never by the event volume): edges are routed to
   the row bands they reach and grouped per (polygon, band); bands are cut
   into cells; each (polygon, cell) pair is classified as boundary (keeps
   the edges a ray from the cell can cross), inside (matches with no edge
   test) or outside (dropped).  The index is grouped to one row per cell:
   ``depth, cx, cy, polys array<struct<polygon_id, county, full, edges>>``.
   It is computed once, written to the shared folder and measured there.
2. **Data-driven cells**: a cell whose measured edges exceed ``MAX_EDGES`` is
   split into 4, 16, ... cells, as deep as its edges ask for, so a point never
   meets a long edge list wherever the coast is ragged.  The depth is part of
   the join key; points look it up by their base cell.
3. **Equi-join on the cell**: each point falls in exactly one cell, so the
   join is at most one index row per point and never multiplies the events.
   When the measured index is small enough it is broadcast and the events are
   not shuffled at all.  Otherwise both sides are shuffled on the cell, and
   the cells that are *measured* to be hot (one may hold a third of all
   events) are salted: their index rows are replicated ``salt`` times and
   each point picks one replica by a hash of its own columns, so a retried
   task routes rows identically.
4. **Exact test** with a higher-order expression over the candidate
   polygons' edges (``tremor.functions.geometry.intersects``): boundary
   points match, so a point on a shared edge matches both polygons.

``keep="all"`` returns one row per (point, matching polygon) and one row with
a null county for unmatched points, like a left spatial join.
``keep="smallest"`` returns exactly one row per point with the smallest
matching county name, resolved per row without any shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.functions.geometry import EDGE_TYPE, crossings, intersects, segment_touches_box
from tremor.session import UNMARKED, broadcast_budget, scratch_path, shuffle_partitions
from tremor.sources.counties import polygon_layer
from tremor.sources.events import require_columns

DEFAULT_CELL_SIZE = 1.0
# A cell with more edges than this is split, at most MAX_DEPTH times in half.
MAX_EDGES, MAX_DEPTH = 256, 6
# Relative padding of a cell's band when clipping edges; clipping only
# prunes candidates, so a generous pad costs little and absorbs rounding.
_PAD = 1e-6
_EDGE_BYTES = 40
_ROW_BYTES = 96


def cell_index(edges: DataFrame, cell_size: float = DEFAULT_CELL_SIZE,
               inside: DataFrame | None = None, depth: int = 0) -> DataFrame:
    """Edge table -> one row per grid cell: ``cx, cy, polys``.

    With ``inside`` (base cells ``_bx, _by``) only their parts are indexed;
    ``cell_size`` is then the base size and cells are its ``2 ** depth``-th part.

    Built without ever holding a polygon's whole edge list in one row: each
    edge is sent to the row bands its y-range reaches (an explode over a
    short integer range), edges are grouped per (polygon, band), and each
    band is cut into the cells its edges span.  A point of a band that is
    left or right of every band edge is outside the polygon, so cells beyond
    the band's edges never need to be listed.

    Each (polygon, cell) pair is then classified once, here, instead of per
    point:

    * *boundary*: an edge touches the cell (box padded slightly, so rounding
      can only add boundary cells): the pair keeps the band edges a ray from
      the cell can cross (those extending right of its left side) and points
      are tested exactly;
    * *inside*: no edge touches the cell and its centre is inside (a
      horizontal ray only crosses edges of its own band): every point of the
      cell matches, with no edge test (``full``);
    * *outside*: dropped.
    """
    s = float(cell_size) / (1 << depth)
    if "polygon_id" not in edges.columns:
        edges = edges.withColumn("polygon_id", F.col("county"))
    lo = F.least(F.col("y1"), F.col("y2")) / F.lit(s)
    hi = F.greatest(F.col("y1"), F.col("y2")) / F.lit(s)
    edge = F.struct(*[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")])
    routed = edges.select(
        "polygon_id", "county", edge.alias("e"),
        F.explode(F.sequence(F.floor(lo - 1 - _PAD).cast("long"),
                             F.floor(hi + _PAD).cast("long"))).alias("cy"))
    cy = F.col("cy")
    y0, y1 = (cy - _PAD) * s, (cy + 1 + _PAD) * s
    bands = (routed
             .where((F.greatest(F.col("e.y1"), F.col("e.y2")) >= y0)
                    & (F.least(F.col("e.y1"), F.col("e.y2")) <= y1))
             .groupBy("polygon_id", "county", "cy")
             .agg(F.collect_list("e").alias("edges"),
                  F.min(F.least(F.col("e.x1"), F.col("e.x2"))).alias("xmin"),
                  F.max(F.greatest(F.col("e.x1"), F.col("e.x2"))).alias("xmax")))
    cells = bands.withColumn("cx", F.explode(F.sequence(
        F.floor(F.col("xmin") / F.lit(s) - _PAD).cast("long"),
        F.floor(F.col("xmax") / F.lit(s) + _PAD).cast("long"))))
    if inside is not None:
        # before the edges are tested against the cells
        cells = cells.join(inside, (F.shiftright("cx", depth) == F.col("_bx"))
                           & (F.shiftright("cy", depth) == F.col("_by")), "left_semi")
    cx = F.col("cx")
    x0, x1 = (cx - _PAD) * s, (cx + 1 + _PAD) * s
    touches = F.exists("edges", lambda e: segment_touches_box(e, x0, y0, x1, y1))
    centre_in = crossings((cx + 0.5) * s, (cy + 0.5) * s, F.col("edges")) % 2 == 1
    right_of_cell = F.filter("edges", lambda e: F.greatest(e["x1"], e["x2"]) >= x0)
    classified = cells.select("cx", "cy", "polygon_id", "county", "edges",
                              touches.alias("touches"))
    pairs = classified.select(
        "cx", "cy", "polygon_id", "county",
        (~F.col("touches") & centre_in).alias("full"),
        F.when(F.col("touches"), right_of_cell)
         .otherwise(F.array().cast(f"array<{EDGE_TYPE}>")).alias("edges"))
    return (pairs.where(F.col("full") | (F.size("edges") > 0))
            .groupBy("cx", "cy")
            .agg(F.collect_list(F.struct("polygon_id", "county", "full", "edges"))
                 .alias("polys")))


def suggest_cell_size(edges: DataFrame, cells_per_polygon: int = 16,
                      lo: float = 0.01, hi: float = 5.0) -> float:
    """A cell size for this polygon layer (one small aggregate over it).

    The median polygon's bounding box is cut into about
    ``cells_per_polygon`` cells, so most cells of a typical polygon are
    *inside* cells (no per-point edge test) while the index stays a few
    rows per polygon.  Clamped to ``[lo, hi]`` degrees.
    """
    layer = polygon_layer(edges)
    side = F.sqrt((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")))
    median = layer.select(F.percentile_approx(side, 0.5).alias("m")).first()["m"]
    if not median:
        return float(hi)
    return float(min(hi, max(lo, median / cells_per_polygon ** 0.5)))


def index_size_bytes(index: DataFrame) -> int:
    """Estimated in-memory size of a cell index (one small aggregate job)."""
    return int(index.agg(F.sum(_row_bytes())).first()[0] or 0)


def _cell_edges() -> Column:
    return F.aggregate("polys", F.lit(0), lambda acc, p: acc + F.size(p["edges"]))


def _row_bytes() -> Column:
    return (_cell_edges() * _EDGE_BYTES + (F.size("polys") + 1) * _ROW_BYTES).cast("long")


@dataclass
class PolygonIndex:
    """A written cell index: ``depth, cx, cy, polys``, and which base cells are split how deep."""
    cells: DataFrame
    cell_size: float
    size_bytes: int
    splits: DataFrame | None = None


def build_index(edges: DataFrame, cell_size: float = DEFAULT_CELL_SIZE,
                max_edges: int = MAX_EDGES) -> PolygonIndex:
    """Compute the cell index once, write it to the shared folder and measure it there.

    An index can be kept and passed to any number of joins in place of the edges.
    """
    spark = edges.sparkSession
    path = scratch_path(spark, "cells")

    def write(cells: DataFrame, depth: int) -> None:
        cells.withColumn("depth", F.lit(depth)).write.options(**UNMARKED) \
            .parquet(f"{path}/part{depth}")

    write(cell_index(edges, cell_size), 0)
    base = spark.read.parquet(f"{path}/part0")
    # An edge list halves with each halving of the cell: a border is a line.
    wanted = F.when(_cell_edges() > max_edges, F.least(F.lit(MAX_DEPTH), F.ceil(F.log2(
        _cell_edges() / F.lit(float(max_edges)))).cast("int"))).otherwise(0)
    measured = base.groupBy(wanted.alias("d")).agg(F.sum(_row_bytes()).alias("b")).collect()
    depths = sorted(r["d"] for r in measured if r["d"])
    if not depths:
        return PolygonIndex(base, float(cell_size), sum(r["b"] for r in measured))
    splits = base.select("cx", "cy", wanted.alias("d")).where(F.col("d") > 0)
    write_to = f"{path}/splits"
    splits.write.options(**UNMARKED).parquet(write_to)
    splits = spark.read.parquet(write_to).select(
        F.col("cx").alias("_bx"), F.col("cy").alias("_by"), F.col("d").alias("_depth"))
    for d in depths:
        write(cell_index(edges, cell_size, splits.where(F.col("_depth") == d), d), d)
    kept = base.join(splits, (F.col("cx") == F.col("_bx")) & (F.col("cy") == F.col("_by")), "left_anti")
    deeper = spark.read.parquet(*[f"{path}/part{d}" for d in depths])
    cells = kept.unionByName(deeper)
    return PolygonIndex(cells, float(cell_size), index_size_bytes(cells), splits)


def with_matches(points: DataFrame, edges: DataFrame | PolygonIndex, *, lon: str = "longitude",
                 lat: str = "latitude", cell_size: float = DEFAULT_CELL_SIZE, salt: int = 16,
                 broadcast: bool | None = None, salt_cols: list[str] | None = None) -> DataFrame:
    """``points`` with ``_m``: the matching ``struct<county, polygon_id>`` of each, as an array.

    ``edges``: an edge table (``polygon_id?, county, ring, x1, y1, x2, y2``) or
    an index of one.  ``broadcast``: None = decide by the measured index size
    against ``spark.sql.autoBroadcastJoinThreshold``; True/False forces a path.
    """
    require_columns(points, lon, lat)
    index = edges if isinstance(edges, PolygonIndex) else build_index(edges, cell_size)
    if broadcast is None:
        broadcast = index.size_bytes <= broadcast_budget(points.sparkSession)
    s = index.cell_size
    px, py = F.col(lon), F.col(lat)
    pts = points.withColumns({"_cx": F.floor(px / F.lit(s)).cast("long"),
                              "_cy": F.floor(py / F.lit(s)).cast("long")})
    if index.splits is None:
        pts = pts.withColumn("_depth", F.lit(0))
    else:
        # one row per split base cell; scaling by a power of two is exact
        pts = (pts.join(index.splits, (F.col("_cx") == F.col("_bx")) & (F.col("_cy") == F.col("_by")),
                        "left").drop("_bx", "_by")
               .withColumn("_depth", F.coalesce("_depth", F.lit(0))))
        parts = F.pow(F.lit(2.0), F.col("_depth"))
        pts = pts.withColumns({"_cx": F.floor(px / F.lit(s) * parts).cast("long"),
                               "_cy": F.floor(py / F.lit(s) * parts).cast("long")})
    idx = index.cells.withColumnsRenamed({"cx": "_cx", "cy": "_cy", "depth": "_depth",
                                          "polys": "_polys"})
    keys = ["_depth", "_cx", "_cy"]
    if broadcast:
        joined = pts.join(F.broadcast(idx), keys, "left")
    else:
        n = max(int(salt), 1)
        hot = _hot_cells(pts, keys) if n > 1 else []
        is_hot = F.concat_ws(":", *keys).isin(hot) if hot else F.lit(False)
        pick = F.pmod(F.xxhash64(*(salt_cols or points.columns)), F.lit(n)).cast("int")
        pts = pts.withColumn("_salt", F.when(is_hot, pick).otherwise(0))
        idx = idx.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(n - 1)))
                                                .otherwise(F.array(F.lit(0)))))
        joined = pts.join(idx, keys + ["_salt"], "left").drop("_salt")
    matches = F.transform(
        F.filter(F.coalesce(F.col("_polys"), F.array()),
                 lambda p: p["full"] | intersects(px, py, p["edges"])),
        lambda p: F.struct(p["county"].alias("county"), p["polygon_id"].alias("polygon_id")))
    return joined.withColumn("_m", matches).drop("_polys", *keys)


def _hot_cells(pts: DataFrame, keys: list[str]) -> list[str]:
    """Cells that hold more points than a shuffle partition should: fewer than partitions."""
    counts = pts.where(F.col("_cx").isNotNull() & F.col("_cy").isNotNull()) \
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    fair = shuffle_partitions(pts.sparkSession)
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [r["c"] for r in counts.where(F.col("n") * fair > total)
            .select(F.concat_ws(":", *keys).alias("c")).collect()]


def spatial_join(points: DataFrame, edges: DataFrame | PolygonIndex, *, keep: str = "all",
                 county_col: str = "county", **how) -> DataFrame:
    """Left spatial join of points with polygons (``intersects``); ``how``: see ``with_matches``."""
    if keep not in ("all", "smallest"):
        raise ValueError("keep must be 'all' or 'smallest'")
    found = with_matches(points, edges, **how)
    # Both forms go through a generator: a filter on the county (the usual
    # next step) cannot be pushed below it, so the exact test runs once per
    # point instead of once per reference to its result.
    hits = F.col("_m") if keep == "all" else F.slice(F.array_sort("_m"), 1, 1)
    return (found.withColumn("_hit", F.explode_outer(hits))
            .withColumn(county_col, F.col("_hit.county"))
            .withColumn("polygon_id", F.col("_hit.polygon_id"))
            .drop("_m", "_hit"))


def point_in_polygon_pairs(points: DataFrame, edges: DataFrame, *, lon: str = "longitude",
                           lat: str = "latitude", cell_size: float = DEFAULT_CELL_SIZE,
                           **kw) -> DataFrame:
    """Only the matching (point, polygon) rows (inner form of the join)."""
    return spatial_join(points, edges, lon=lon, lat=lat, keep="all",
                        cell_size=cell_size, **kw).where(F.col("polygon_id").isNotNull())


def density_grid(points: DataFrame, cell_deg: float, lon: str = "longitude",
                 lat: str = "latitude") -> DataFrame:
    """Event counts per grid cell (spatial density / hotspots)."""
    s = float(cell_deg)
    return (points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull())
            .groupBy((F.floor(F.col(lat) / F.lit(s))).cast("long").alias("lat_cell"),
                     (F.floor(F.col(lon) / F.lit(s))).cast("long").alias("lon_cell"))
            .agg(F.count(F.lit(1)).alias("n_events")))

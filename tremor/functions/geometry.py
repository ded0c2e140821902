"""Planar point-in-polygon test as a native higher-order expression.

A polygon is an array of edges ``struct<x1, y1, x2, y2: double>`` covering
all its rings (outer rings, holes and further parts alike).  A point
*intersects* the polygon when it lies on an edge or when a ray towards +x
crosses the edges an odd number of times (even-odd rule, which handles
holes and multi-part polygons without knowing which ring is which).

Everything is multiplication and comparison: no division, so no division by
zero under ANSI mode, and horizontal edges simply never count as crossings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EDGE_TYPE = "struct<x1:double,y1:double,x2:double,y2:double>"


def _cross(e: Column, px: Column, py: Column) -> Column:
    # > 0 when the point is left of the directed edge, 0 when on its line.
    return (e["x2"] - e["x1"]) * (py - e["y1"]) - (px - e["x1"]) * (e["y2"] - e["y1"])


def on_boundary(px: Column, py: Column, edges: Column) -> Column:
    """True when the point lies on any edge (boundary counts as inside)."""
    def hit(e):
        return ((_cross(e, px, py) == 0)
                & px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
                & py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))
    return F.exists(edges, hit)


def crossings(px: Column, py: Column, edges: Column) -> Column:
    """Number of edges a ray from the point towards +x crosses."""
    def step(acc, e):
        straddles = (e["y1"] > py) != (e["y2"] > py)
        right_of_point = F.when(e["y2"] > e["y1"], _cross(e, px, py) > 0) \
                          .otherwise(_cross(e, px, py) < 0)
        return acc + F.when(straddles & right_of_point, F.lit(1)).otherwise(F.lit(0))
    return F.aggregate(edges, F.lit(0), step)


def intersects(px: Column, py: Column, edges: Column) -> Column:
    """Point-intersects-polygon: on the boundary, or inside by the even-odd rule."""
    return on_boundary(px, py, edges) | (crossings(px, py, edges) % 2 == 1)


def segment_touches_box(e: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """True when edge ``e`` meets the closed box ``[x0, x1] x [y0, y1]``.

    Boxes overlap, and the four corners are not all strictly on one side of
    the edge's line (separating-axis test for a segment and a box).
    """
    overlap = ((F.greatest(e["x1"], e["x2"]) >= x0) & (F.least(e["x1"], e["x2"]) <= x1)
               & (F.greatest(e["y1"], e["y2"]) >= y0) & (F.least(e["y1"], e["y2"]) <= y1))
    sides = [_cross(e, cx, cy) for cx, cy in ((x0, y0), (x1, y0), (x0, y1), (x1, y1))]
    all_left = sides[0] > 0
    all_right = sides[0] < 0
    for d in sides[1:]:
        all_left = all_left & (d > 0)
        all_right = all_right & (d < 0)
    return overlap & ~all_left & ~all_right

"""Spatial join (C1): grid plan equals a brute-force exact test."""

from fractions import Fraction

import pytest

from tremor.operators import spatial
from tremor.sources.counties import edges_from_rings

# Hand-written polygons: a square with a hole, a neighbour sharing an edge,
# a two-part polygon and a triangle with sloped edges.
POLYS = [
    ("P", "Pine", 0, [(0, 0), (4, 0), (4, 4), (0, 4)]),
    ("P", "Pine", 1, [(1, 1), (3, 1), (3, 3), (1, 3)]),
    ("R", "Reed", 0, [(4, 0), (6, 0), (6, 4), (4, 4), (4, 0)]),
    ("Q", "Quill", 0, [(10, 0), (11, 0), (11, 1), (10, 1), (10, 0)]),
    ("Q", "Quill", 100000, [(12, 0), (13, 0), (13, 1), (12, 1), (12, 0)]),
    ("T", "Tarn", 0, [(0, 5), (6, 5), (0, 8), (0, 5)]),
]
POINTS = [
    (0.5, 0.5), (2, 2), (1, 2), (1, 1), (3, 3), (0, 0), (4, 2), (4, 4), (4, 0),
    (5, 2), (6, 4), (6.5, 2), (10.5, 0.5), (11.5, 0.5), (12, 0.25), (13, 1),
    (3, 6.5), (2, 7), (1, 6), (0, 8), (6, 5), (3, 5), (-1, -1), (2.5, 4), (2, 1),
    (0.25, 3.75), (5.999, 0.001), (3.0, 6.5000001), (3.0, 6.4999999), (4, 3.5),
]


def _edges(poly_rows):
    out = []
    for pid, name, _ring, pts in poly_rows:
        ring = pts if pts[0] == pts[-1] else pts + [pts[0]]
        out += [(pid, name, a, b) for a, b in zip(ring[:-1], ring[1:])]
    return out


def brute_force(points, poly_rows):
    """Exact rational even-odd + on-boundary test, per (point, polygon)."""
    by_poly = {}
    for pid, name, a, b in _edges(poly_rows):
        by_poly.setdefault((pid, name), []).append((a, b))
    hits = set()
    for i, (px, py) in enumerate(points):
        px, py = Fraction(px), Fraction(py)
        for (pid, name), edges in by_poly.items():
            on, cross_n = False, 0
            for (x1, y1), (x2, y2) in edges:
                x1, y1, x2, y2 = map(Fraction, (x1, y1, x2, y2))
                c = (x2 - x1) * (py - y1) - (px - x1) * (y2 - y1)
                if c == 0 and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
                    on = True
                if (y1 > py) != (y2 > py) and ((c > 0) if y2 > y1 else (c < 0)):
                    cross_n += 1
            if on or cross_n % 2 == 1:
                hits.add((i, name))
    return hits


@pytest.fixture(scope="module")
def frames(spark):
    rings = spark.createDataFrame(
        [(pid, name, ring, [(float(x), float(y)) for x, y in pts]) for pid, name, ring, pts in POLYS],
        "polygon_id string, county string, ring int, vertices array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(POINTS)]
                                + [(len(POINTS), None, None)],
                                "i int, longitude double, latitude double")
    return pts, edges_from_rings(rings)


@pytest.mark.parametrize("cell,broadcast,salt", [(1.0, True, 1), (0.7, True, 1), (3.0, False, 5),
                                                 (1.0, False, 1), (2.5, None, 16),
                                                 (0.25, True, 1), (0.5, False, 3)])
def test_grid_equals_brute_force(spark, frames, cell, broadcast, salt):
    pts, edges = frames
    out = spatial.spatial_join(pts, edges, keep="all", cell_size=cell, broadcast=broadcast,
                               salt=salt, salt_cols=["i"])
    rows = out.collect()
    got = {(r["i"], r["county"]) for r in rows if r["county"] is not None}
    assert got == brute_force(POINTS, POLYS)
    # left join: every point kept, unmatched ones once with a null county
    matched = {i for i, _ in got}
    unmatched = [r["i"] for r in rows if r["county"] is None]
    assert sorted(unmatched) == sorted(set(range(len(POINTS) + 1)) - matched)
    assert len(rows) == len(got) + len(unmatched)


def test_smallest_keeps_one_row_per_point(spark, frames):
    pts, edges = frames
    out = spatial.spatial_join(pts, edges, keep="smallest", cell_size=1.0).collect()
    assert len(out) == len(POINTS) + 1
    expected = {}
    for i, name in brute_force(POINTS, POLYS):
        expected[i] = min(expected.get(i, name), name)
    assert {r["i"]: r["county"] for r in out if r["county"]} == expected


def test_boundary_cases(spark, frames):
    pts, edges = frames
    got = brute_force(POINTS, POLYS)
    idx = {p: i for i, p in enumerate(POINTS)}
    assert (idx[(4, 2)], "Pine") in got and (idx[(4, 2)], "Reed") in got   # shared edge
    assert (idx[(2, 2)], "Pine") not in got                                # inside the hole
    assert (idx[(1, 2)], "Pine") in got                                    # on the hole edge
    assert (idx[(11.5, 0.5)], "Quill") not in got                          # between parts
    assert (idx[(12, 0.25)], "Quill") in got                               # second part edge
    assert (idx[(3, 6.5)], "Tarn") in got                                  # sloped edge
    res = spatial.spatial_join(pts, edges, keep="all").collect()
    assert {(r["i"], r["county"]) for r in res if r["county"]} == got


def test_fixture_counts(spark, sf_mid):
    from tremor.sources.testdata import event_view, fixture_county_edges
    pairs = spatial.point_in_polygon_pairs(event_view(spark, sf_mid), fixture_county_edges(spark),
                                           salt_cols=["id"])
    assert pairs.count() == 12530
    assert pairs.select("id").distinct().count() == 12514
    per = {r["county"]: r["count"] for r in pairs.groupBy("county").count().collect()}
    assert per == {"A": 3900, "B": 3692, "C": 3792, "D": 1146}


def test_interior_cells_skip_edges(spark, frames):
    _, edges = frames
    idx = spatial.cell_index(edges, 0.25)
    rows = idx.selectExpr("cx", "cy", "inline(polys)").collect()
    full = [r for r in rows if r["full"]]
    assert full and all(len(r["edges"]) == 0 for r in full)
    # a cell wholly inside Pine's hole is not listed for Pine at all
    assert not [r for r in rows if r["county"] == "Pine" and (r["cx"], r["cy"]) == (7, 7)]
    # a cell wholly inside Pine's ring (between outer edge and hole) is full
    assert [r for r in rows if r["county"] == "Pine" and (r["cx"], r["cy"]) == (1, 1) and r["full"]]


def test_index_size_is_measured(spark, frames):
    _, edges = frames
    idx = spatial.cell_index(edges, 1.0)
    assert spatial.index_size_bytes(idx) > 0


def test_suggested_cell_size(spark, frames):
    pts, edges = frames
    size = spatial.suggest_cell_size(edges)
    assert 0.01 <= size <= 5.0
    got = {(r["i"], r["county"]) for r in
           spatial.spatial_join(pts, edges, cell_size=size).collect() if r["county"]}
    assert got == brute_force(POINTS, POLYS)
    from tremor.sources.testdata import fixture_county_edges
    assert spatial.suggest_cell_size(fixture_county_edges(spark)) == pytest.approx(1.25)


def _circle(pid, cx, cy, r, n):
    import math
    pts = [(cx + r * math.cos(2 * math.pi * i / n), cy + r * math.sin(2 * math.pi * i / n))
           for i in range(n)]
    return (pid, pid, 0, pts)


@pytest.mark.parametrize("broadcast", [True, False])
def test_cells_with_many_edges_are_split(spark, broadcast):
    """A ragged polygon under one hot cell: split cells, the same answer."""
    import random
    rnd = random.Random(3)
    polys = [_circle("ring", 0.5, 0.5, 0.4, 400), ("box", "box", 0, [(0, 0), (4, 0), (4, 4), (0, 4)])]
    pts = [(rnd.uniform(0, 1), rnd.uniform(0, 1)) for _ in range(400)] + \
          [(rnd.uniform(-2, 5), rnd.uniform(-2, 5)) for _ in range(60)] + [(0.9, 0.5), (4.0, 2.0)]
    rings = spark.createDataFrame(
        [(p, n, r, [(float(x), float(y)) for x, y in v]) for p, n, r, v in polys],
        "polygon_id string, county string, ring int, vertices array<struct<x:double,y:double>>")
    index = spatial.build_index(edges_from_rings(rings), 1.0, max_edges=40)
    depths = {r["depth"]: r["n"] for r in
              index.cells.selectExpr("depth", "size(polys) n").groupBy("depth").sum("n")
              .toDF("depth", "n").collect()}
    assert set(depths) == {0, 4} and index.splits.count() == 1      # 400 edges: 2^4 x 40 > 400
    most = index.cells.selectExpr("aggregate(polys, 0, (a, p) -> a + size(p.edges)) n").agg({"n": "max"})
    assert most.first()[0] <= 80
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)],
                               "i int, longitude double, latitude double")
    out = spatial.spatial_join(df, index, broadcast=broadcast, salt=4, salt_cols=["i"])
    assert {(r["i"], r["county"]) for r in out.collect() if r["county"]} == brute_force(pts, polys)


def test_only_measured_hot_cells_are_salted(spark):
    from pyspark.sql import functions as F
    pts = spark.range(1000).select(
        F.lit(0).alias("_depth"), F.when(F.col("id") < 600, 5).otherwise(F.col("id")).alias("_cx"),
        F.lit(1).alias("_cy"))
    assert spatial._hot_cells(pts, ["_depth", "_cx", "_cy"]) == ["0:5:1"]
    assert spatial._hot_cells(pts.where("_cx <> 5"), ["_depth", "_cx", "_cy"]) == []


def test_index_is_computed_once(spark, frames, monkeypatch):
    pts, edges = frames
    calls, real = [], spatial.cell_index
    monkeypatch.setattr(spatial, "cell_index", lambda *a, **k: calls.append(a) or real(*a, **k))
    index = spatial.build_index(edges)
    one = spatial.spatial_join(pts, index).collect()
    two = spatial.spatial_join(pts, index, broadcast=False).collect()
    assert len(calls) == 1 and sorted(map(str, one)) == sorted(map(str, two))
    # the join reads the written index, not the edges
    plan = spatial.spatial_join(pts, index)._jdf.queryExecution().optimizedPlan().toString()
    assert "vertices" not in plan and "polys" in plan

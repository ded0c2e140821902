"""Density clusters and the components under them, against plain searches."""

import random

import pytest

from tremor.operators import clusters


def labels(links):
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for start in sorted(near):
        todo = [start] if start not in out else []
        while todo:
            n = todo.pop()
            if n not in out:
                out[n] = start
                todo += near[n]
    return out


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)], [(5, 5)], [],
    [(1, 2), (2, 1), (4, 3), (9, 3), (-7, 9)],
    [(random.Random(i).randrange(90), random.Random(i + 500).randrange(90)) for i in range(60)]])
def test_components(spark, links):
    got = clusters.components(spark.createDataFrame(links, "a long, b long"))
    want = {n: c for n, c in labels([x for x in links if x[0] != x[1]]).items() if n != c}
    assert {r["node"]: r["component"] for r in got.collect()} == want


def test_clusters_core_border_noise(spark):
    rnd = random.Random(1)
    points = [(-0.5 + rnd.randrange(-12, 12), 0.5 + rnd.randrange(-9, 9)) for _ in range(260)]
    points += [(3.5, 3.5)] * 30 + [(4.5, 4.5)] * 30 + [(-9.5, -7.5)] * 40 + [(None, 1.0), (30.5, 40.5)]
    cells = {}
    for x, y in points:
        if x is not None:
            cells[y // 1, x // 1] = cells.get((y // 1, x // 1), 0) + 1

    def around(c):
        return [d for d in cells if abs(c[0] - d[0]) <= 1 and abs(c[1] - d[1]) <= 1]
    core = {c for c in cells if sum(cells[d] for d in around(c)) >= 30}
    name = {c: c for c in core} | labels([(a, b) for a in core for b in around(a) if b in core and a != b])
    assert 1 < len(set(name.values())) < len(core) < len(cells)
    want = {}
    for c in cells:
        near = [name[d] for d in around(c) if d in core]
        label = name.get(c) or (min(near) if near else None)
        want[c] = (cells[c], "core" if c in core else "border" if near else "noise",
                   label and f"{int(label[0])}:{int(label[1])}")
    df = spark.createDataFrame(points, "longitude double, latitude double").repartition(5)
    got = clusters.density_clusters(df, 1.0, 30).collect()
    assert {(r["lat_cell"], r["lon_cell"]): (r["n_events"], r["role"], r["cluster"]) for r in got} == want
    assert clusters.density_clusters(df.limit(0), 1.0, 30).count() == 0

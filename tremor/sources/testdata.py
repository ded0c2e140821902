"""Stand-in inputs built from the driver's test tables.

The test folders hold no seismic events, so raw events are derived from
``orders JOIN customer`` (one event per order) and a four-polygon county
layer stands in for the census shapefile.  These builders only produce rows
in the raw schema; every query then runs the library's own code on them
(place parsing, lookups, spatial join, loads), and nothing downstream uses
how the rows were made.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.functions.tables import local_table
from tremor.schemas import RAW_FIELDS
from tremor.sources.counties import edges_from_rings

# FIXED VALUES — stand-in state text per customer nation key 0..24.
NATION_STATE_TEXT = [
    "California", "CA", "Nevada", "NV", "Alaska", "AK", "Hawaii", "Texas",
    "Oklahoma", "Washington", "Puerto Rico", "Guam", "Ohio", "AL", "Alabama",
    "Mexico", "Georgia", "Vermont", "Montana", "MT", "New York", "Kansas",
    "Missouri", "Japan", "CA",
]
# FIXED VALUES — stand-in compass direction per order key mod 8.
DIRECTIONS = ["N", "NNE", "E", "SE", "S", "SW", "W", "NW"]

# FIXED VALUES — stand-in county polygons (lon, lat rings; ring 0 = outer).
FIXTURE_COUNTIES = [
    ("A", "A", 0, [(-120, 30), (-115, 30), (-115, 35), (-120, 35), (-120, 30)]),
    ("B", "B", 0, [(-115, 30), (-110, 30), (-110, 35), (-115, 35), (-115, 30)]),
    ("C", "C", 0, [(-120, 35), (-110, 35), (-120, 40), (-120, 35)]),
    ("D", "D", 0, [(-113, 37), (-110, 37), (-110, 40), (-113, 40), (-113, 37)]),
    ("D", "D", 1, [(-112, 38), (-111, 38), (-111, 39), (-112, 39), (-112, 38)]),
]


# FIXED VALUES — stand-in county file: a part with a hole, two parts, a collection,
# a feature without a geometry.
_SQUARE = [[-119, 31], [-116, 31], [-116, 34], [-119, 34], [-119, 31]]
_HOLE = [[-118, 32], [-117, 32], [-117, 33], [-118, 33], [-118, 32]]
_ISLANDS = [[[[-115, 30], [-113, 30], [-113, 32], [-115, 30]]],
            [[[-112, 33], [-110, 33], [-110, 36], [-112, 36], [-112, 33]]]]
_TRIANGLE = [[-120, 36], [-114, 36], [-117, 39], [-120, 36]]
_STRIP = [[-113, 37], [-110, 37], [-110, 38], [-113, 38], [-113, 37]]
FIXTURE_COUNTY_FILE = [
    ("Hollow", {"type": "Polygon", "coordinates": [_SQUARE, _HOLE]}),
    ("Islands", {"type": "MultiPolygon", "coordinates": _ISLANDS}),
    ("Mixed", {"type": "GeometryCollection", "geometries": [
        {"type": "Polygon", "coordinates": [_TRIANGLE]},
        {"type": "MultiPolygon", "coordinates": [[_STRIP]]}]}),
    ("Nowhere", None),
]


def county_file_rings() -> list[tuple[str, list]]:
    """``(county, ring)`` of the stand-in county file."""
    out = []
    for name, g in FIXTURE_COUNTY_FILE:
        for part in [] if g is None else g.get("geometries", [g]):
            polygons = [part["coordinates"]] if part["type"] == "Polygon" else part["coordinates"]
            out += [(name, ring) for polygon in polygons for ring in polygon]
    return out


def write_county_file(spark: SparkSession, path: str) -> None:
    """The stand-in county file as one GeoJSON FeatureCollection."""
    features = [{"type": "Feature", "properties": {"NAME": n}, "geometry": g}
                for n, g in FIXTURE_COUNTY_FILE]
    text = json.dumps({"type": "FeatureCollection", "features": features})
    local_table(spark, [(text,)], [("value", "string")]).coalesce(1).write.text(path)


def _d(c) -> F.Column:
    return c.cast("double")


def event_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events (``RAW_SCHEMA`` columns) derived from orders and customers."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    k = F.col("o_orderkey")
    cust = F.col("c_custkey")
    state = F.element_at(F.array(*[F.lit(s) for s in NATION_STATE_TEXT]),
                         F.col("c_nationkey") + 1)
    direction = F.element_at(F.array(*[F.lit(d) for d in DIRECTIONS]), (k % 8 + 1).cast("int"))
    place = (F.when(k % 11 == 0, F.concat(state, F.lit(" region")))
             .when(k % 13 == 0, F.lit("S of the Fiji Islands"))
             .when(k % 17 == 0, F.lit("3 km N of Foo, Bar, CA"))
             .otherwise(F.concat((k % 97 + 1).cast("string"), F.lit(" km "), direction,
                                 F.lit(" of "), F.col("c_name"), F.lit(", "), state)))
    segment = F.col("c_mktsegment")
    cols = {
        "time": F.col("o_orderdate"),
        "latitude": F.lit(30.0) + _d((cust * 37) % 1000) / F.lit(100.0),
        "longitude": F.lit(-120.0) + _d((cust * 91) % 1000) / F.lit(100.0),
        "depth": _d(F.col("o_custkey") % 40),
        "mag": F.col("o_totalprice") / F.lit(70000.0),
        "magType": (F.when(F.col("o_orderpriority") == "1-URGENT", "mww")
                    .when(F.col("o_orderpriority") == "2-HIGH", "mw")
                    .when(F.col("o_orderpriority") == "5-LOW", "md").otherwise("ml")),
        "nst": _d(k % 60) / F.lit(2.0),
        "gap": _d((k % 36) * 10),
        "dmin": F.when(k % 70 == 1, F.lit(None)).otherwise(_d(k % 9) / F.lit(8.0)),
        "rms": F.when(k % 70 == 1, F.lit(None)).otherwise(_d(k % 7) / F.lit(4.0)),
        "net": (F.when(segment == "BUILDING", "ci").when(segment == "MACHINERY", "nn")
                .when(segment == "HOUSEHOLD", "ak").otherwise("us")),
        "id": F.concat(F.lit("ev"), k.cast("string")),
        "updated": F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"),
        "place": place,
        "type": F.when(k % 20 == 0, "quarry blast").otherwise("earthquake"),
        "horizontalError": _d(k % 4) / F.lit(4.0),
        "depthError": _d(k % 3) / F.lit(2.0),
        "magError": _d(k % 5) / F.lit(10.0),
        "magNst": F.when(k % 50 == 0, F.lit(None)).otherwise(_d(k % 30) / F.lit(2.0)),
        "status": F.when(F.col("o_orderstatus") == "F", "reviewed").otherwise("automatic"),
        "locationSource": (F.when(segment == "BUILDING", "ci")
                           .when(segment == "MACHINERY", "nn").otherwise("us")),
        "magSource": F.when(k % 3 == 0, "us").otherwise("nc"),
    }
    return j.select(*[cols[name].cast(dtype).alias(name) if name not in ("time", "updated")
                      else cols[name].alias(name) for name, dtype in RAW_FIELDS])


def fixture_county_edges(spark: SparkSession) -> DataFrame:
    """Edge table of the four stand-in counties (a hole in D, shared edges)."""
    rows = [(pid, name, ring, [{"x": float(x), "y": float(y)} for x, y in pts])
            for pid, name, ring, pts in FIXTURE_COUNTIES]
    rings = local_table(spark, rows, [("polygon_id", "string"), ("county", "string"),
                                      ("ring", "int"),
                                      ("vertices", "array<struct<x:double,y:double>>")])
    return edges_from_rings(rings)

"""County polygon sources.

Polygons enter as edges ``struct<x1, y1, x2, y2>`` in longitude/latitude
degrees (x = longitude).  Four input forms are accepted:

* an edge table: ``polygon_id, county, ring, x1, y1, x2, y2`` (one row per edge);
* a ring table: ``polygon_id, county, ring, vertices array<struct<x, y>>``;
* a GeoJSON FeatureCollection (polygons, multi-polygons, collections of them);
* line-delimited GeoJSON (one such Feature per line), split across tasks.

All of them end in ``polygon_layer``: one row per polygon with its edge
array and bounding box.  A polygon's edge list is bounded by its geometry,
not by the event volume, so collecting it into one row is safe.

The source must already be in longitude/latitude degrees; no general CRS
transformation is done here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def edges_from_rings(rings: DataFrame) -> DataFrame:
    """Rings (vertex arrays, closed or not) -> one row per edge."""
    v = F.col("vertices")
    closed = F.when(
        (F.element_at(v, 1)["x"] == F.element_at(v, -1)["x"])
        & (F.element_at(v, 1)["y"] == F.element_at(v, -1)["y"]), v
    ).otherwise(F.concat(v, F.array(F.element_at(v, 1))))
    with_closed = rings.withColumn("vertices", closed)
    n = F.size("vertices") - 1
    pairs = F.arrays_zip(F.slice("vertices", 1, n).alias("a"),
                         F.slice("vertices", 2, n).alias("b"))
    return (with_closed
            .select("polygon_id", "county", "ring", F.explode(pairs).alias("e"))
            .select("polygon_id", "county", "ring",
                    F.col("e.a.x").cast("double").alias("x1"),
                    F.col("e.a.y").cast("double").alias("y1"),
                    F.col("e.b.x").cast("double").alias("x2"),
                    F.col("e.b.y").cast("double").alias("y2")))


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """Edge table stored as parquet."""
    return spark.read.parquet(path)


_GEOMETRY = [T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]
_FEATURE = T.StructType([
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.StructType(_GEOMETRY + [
        T.StructField("geometries", T.ArrayType(T.StructType(_GEOMETRY)))])),
])
POLYGONS = ("Polygon", "MultiPolygon")


def _features(spark: SparkSession, path: str, name_field: str, id_field: str | None,
              line_delimited: bool) -> DataFrame:
    """``polygon_id, county, geometry type, part_no, geom`` of every simple geometry.

    Without ``id_field`` a feature is known by its file and place in it, or
    (line-delimited) by a hash of its line: ids that a rerun gives again.  A
    line that occurs twice is one polygon.
    """
    if line_delimited:
        features = (spark.read.text(path).where(F.trim("value") != "")
                    .select(F.sha1("value").alias("fid"), F.from_json("value", _FEATURE).alias("f"))
                    .dropDuplicates(["fid"]))
    else:
        schema = T.StructType([T.StructField("features", T.ArrayType(_FEATURE))])
        # one file is one JSON document, read in one task; its features go on in many
        features = (spark.read.schema(schema).option("multiLine", True).json(path)
                    .select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"),
                            F.posexplode("features").alias("place", "f"))
                    .select(F.concat_ws(":", "file", "place").alias("fid"), "f")
                    .repartition("fid"))
    pid = F.col("f.properties")[id_field] if id_field else F.col("fid")
    g = F.col("f.geometry")
    simple = F.when(g["type"] == "GeometryCollection", g["geometries"]) \
              .otherwise(F.array(F.struct(g["type"].alias("type"),
                                          g["coordinates"].alias("coordinates"))))
    return features.select(pid.alias("polygon_id"), F.col("f.properties")[name_field].alias("county"),
                           F.posexplode_outer(simple).alias("geom_no", "geom"))


def geojson_report(spark: SparkSession, path: str, name_field: str = "NAME",
                   id_field: str | None = None, line_delimited: bool = False) -> DataFrame:
    """Geometries that are no polygons: ``polygon_id, county, geometry_type``.

    A feature without a geometry, or with an empty collection, has type ``none``.
    """
    kind = F.coalesce("geom.type", F.lit("none"))
    return (_features(spark, path, name_field, id_field, line_delimited)
            .where(~kind.isin(*POLYGONS))
            .select("polygon_id", "county", kind.alias("geometry_type")))


def read_geojson(spark: SparkSession, path: str, name_field: str = "NAME",
                 id_field: str | None = None, line_delimited: bool = False,
                 unsupported: str = "raise") -> DataFrame:
    """GeoJSON -> edge table.

    Polygons, multi-polygons and collections of them are read, a feature
    without a geometry has no edges.  Any other geometry (a point, a line)
    fails the read, or with ``unsupported="skip"`` is left out; both kinds are
    listed by ``geojson_report``.

    A FeatureCollection is one JSON document, so Spark parses each file in one
    task (fine for a county layer of a few tens of MB).  ``line_delimited``
    reads one Feature per line instead (GeoJSON text sequences / ndjson),
    which Spark splits across tasks for large layers.

    Polygon and MultiPolygon coordinates have different nesting depths, so
    the coordinates are read as JSON text and decoded per geometry type.
    """
    poly_t = "array<array<array<double>>>"
    multi_t = "array<array<array<array<double>>>>"
    kind, coordinates = F.col("geom.type"), F.col("geom.coordinates")
    none = F.array().cast(multi_t)
    other = none if unsupported == "skip" else F.raise_error(
        F.concat(F.lit("unsupported geometry "), kind, F.lit(" of "),
                 F.coalesce("county", "polygon_id"))).cast(multi_t)
    parts = F.when(kind.isNull(), none) \
             .when(kind == "Polygon", F.array(F.from_json(coordinates, poly_t))) \
             .when(kind == "MultiPolygon", F.from_json(coordinates, multi_t)).otherwise(other)
    rings = (_features(spark, path, name_field, id_field, line_delimited)
             .select("polygon_id", "county", "geom_no", F.posexplode(parts).alias("part", "rings"))
             .select("polygon_id", "county", "geom_no", "part",
                     F.posexplode("rings").alias("r", "coords"))
             .select("polygon_id", "county",
                     ((F.col("geom_no") * 100000 + F.col("part")).cast("long") * 100000
                      + F.col("r")).alias("ring"),
                     F.transform("coords", lambda c: F.struct(c[0].alias("x"), c[1].alias("y")))
                     .alias("vertices")))
    return edges_from_rings(rings)


def polygon_layer(edges: DataFrame) -> DataFrame:
    """Edge rows -> ``polygon_id, county, edges, xmin, xmax, ymin, ymax``.

    Without a ``polygon_id`` column the county name identifies the polygon.
    """
    if "polygon_id" not in edges.columns:
        edges = edges.withColumn("polygon_id", F.col("county"))
    edge = F.struct(*[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")])
    return (edges.groupBy("polygon_id", "county")
            .agg(F.collect_list(edge).alias("edges"),
                 F.least(F.min("x1"), F.min("x2")).alias("xmin"),
                 F.greatest(F.max("x1"), F.max("x2")).alias("xmax"),
                 F.least(F.min("y1"), F.min("y2")).alias("ymin"),
                 F.greatest(F.max("y1"), F.max("y2")).alias("ymax")))

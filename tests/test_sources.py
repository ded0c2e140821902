"""Sources and sinks: typed CSV scan, null tokens, month folders, GeoJSON polygons."""

import json
import os
import tempfile

import pytest

from tremor.schemas import RAW_COLUMNS
from tremor.sources import events as ev
from tremor.sources.counties import polygon_layer, read_geojson


def _csv(path, rows, header=RAW_COLUMNS):
    with open(path, "w") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def _row(i, mag="2.5", place="5 km N of Foo, CA", time="2024-01-15T10:00:00.000Z"):
    vals = {c: "1.0" for c in RAW_COLUMNS}
    vals.update(time=time, updated=time, id=f"ev{i}", mag=mag, place=f'"{place}"',
                magType="ml", net="us", type="earthquake", status="reviewed",
                locationSource="us", magSource="us")
    return [vals[c] for c in RAW_COLUMNS]


def test_csv_null_tokens_and_types(spark):
    d = tempfile.mkdtemp(prefix="tremor-csv-", dir="/tmp")
    _csv(f"{d}/m.csv", [_row(1), _row(2, mag="NaN"), _row(3, place="NA"), _row(4, mag="")])
    df = ev.read_events_csv(spark, f"{d}/m.csv")
    assert [f.name for f in df.schema.fields] == RAW_COLUMNS
    rows = {r["id"]: r for r in df.collect()}
    assert rows["ev1"]["mag"] == 2.5 and rows["ev2"]["mag"] is None
    assert rows["ev3"]["place"] is None and rows["ev4"]["mag"] is None
    assert str(df.schema["time"].dataType) == "TimestampType()"
    assert ev.read_events_csv(spark, f"{d}/m.csv").na.drop().count() == 1


def test_csv_header_is_checked(spark):
    d = tempfile.mkdtemp(prefix="tremor-csv-", dir="/tmp")
    _csv(f"{d}/bad.csv", [_row(1)], header=["x"] + RAW_COLUMNS[1:])
    with pytest.raises(Exception):
        ev.read_events_csv(spark, f"{d}/bad.csv").collect()


def test_month_folders_round_trip(spark, sf_small):
    from tremor.sources.testdata import event_view
    raw = event_view(spark, sf_small)
    root = tempfile.mkdtemp(prefix="tremor-months-", dir="/tmp") + "/raw"
    ev.write_months(raw, root)
    back = ev.read_months(spark, root)
    assert back.count() == raw.count()
    one_year = ev.read_months(spark, root, first_year=1996, last_year=1996)
    assert one_year.count() == raw.where("year(time) = 1996").count()
    assert {"year", "month"} <= set(back.columns)


def test_month_spine(spark):
    spine = ev.month_spine(spark, 2020, 2021).collect()
    assert len(spine) == 24
    feb = [r for r in spine if (r["year"], r["month"]) == (2020, 2)][0]
    assert str(feb["month_end"]) == "2020-02-29" and str(feb["next_month"]) == "2020-03-01"


def test_source_filter_half_open(spark, sf_small):
    from tremor.sources.testdata import event_view
    raw = event_view(spark, sf_small)
    got = ev.source_filter(raw, "1996-01-01", "1996-02-01", 3.0).collect()
    assert all(r["mag"] >= 3.0 and r["time"].year == 1996 and r["time"].month == 1 for r in got)
    times = [r["time"] for r in got]
    assert times == sorted(times)


def test_required_columns(spark):
    df = spark.createDataFrame([(1.0,)], "latitude double")
    with pytest.raises(KeyError):
        ev.require_columns(df, "latitude", "longitude")
    assert ev.has_columns(df, "latitude")


def test_geojson_polygons(spark):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"NAME": "Alder"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]}},
        {"type": "Feature", "properties": {"NAME": "Birch"},
         "geometry": {"type": "MultiPolygon", "coordinates": [
             [[[5, 5], [6, 5], [6, 6], [5, 5]]], [[[8, 8], [9, 8], [9, 9], [8, 8]]]]}},
    ]}
    path = os.path.join(tempfile.mkdtemp(prefix="tremor-geo-", dir="/tmp"), "c.geojson")
    with open(path, "w") as f:
        json.dump(fc, f)
    edges = read_geojson(spark, path)
    per = {r["county"]: r["count"] for r in edges.groupBy("county").count().collect()}
    assert per == {"Alder": 4, "Birch": 6}
    layer = {r["county"]: r for r in polygon_layer(edges).collect()}
    assert (layer["Birch"]["xmin"], layer["Birch"]["xmax"]) == (5.0, 9.0)


def test_month_audit_shows_gaps(spark, sf_small):
    from tremor.sources.testdata import event_view
    raw = event_view(spark, sf_small).where("NOT (year(time) = 1996 AND month(time) = 3)")
    audit = {(r["year"], r["month"]): r["n_events"] for r in ev.month_audit(raw).collect()}
    assert audit[(1996, 3)] == 0
    assert sum(audit.values()) == raw.count()


def test_geojson_line_delimited(spark):
    d = tempfile.mkdtemp(prefix="tremor-geo-", dir="/tmp")
    feats = [
        {"type": "Feature", "properties": {"NAME": "Alder", "GEOID": "01"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 0]]]}},
        {"type": "Feature", "properties": {"NAME": "Birch", "GEOID": "02"},
         "geometry": {"type": "MultiPolygon", "coordinates": [
             [[[5, 5], [6, 5], [6, 6], [5, 5]]], [[[8, 8], [9, 8], [9, 9], [8, 8]]]]}},
    ]
    with open(f"{d}/c.geojsonl", "w") as f:
        for feat in feats:
            f.write(json.dumps(feat) + "\n")
    edges = read_geojson(spark, f"{d}/c.geojsonl", id_field="GEOID", line_delimited=True)
    per = {r["polygon_id"]: r["count"] for r in edges.groupBy("polygon_id").count().collect()}
    assert per == {"01": 3, "02": 6}
    no_id = read_geojson(spark, f"{d}/c.geojsonl", line_delimited=True)
    assert no_id.select("polygon_id").distinct().count() == 2


def test_union_frames_tolerates_empty_and_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, place string")
    b = spark.createDataFrame([], "id int, place string")
    c = spark.createDataFrame([(3,)], "id int")
    got = sorted((r["id"], r["place"]) for r in ev.union_frames([a, b, c]).collect())
    assert got == [(1, "x"), (3, None)]
    with pytest.raises(ValueError):
        ev.union_frames([])


def test_month_spine_of_data(spark, sf_small):
    from tremor.sources.testdata import event_view
    raw = event_view(spark, sf_small)
    spine = ev.month_spine_of(raw).collect()
    lo = raw.selectExpr("min(time) m").first()["m"]
    hi = raw.selectExpr("max(time) m").first()["m"]
    assert (spine[0]["year"], spine[0]["month"]) == (lo.year, lo.month)
    assert (spine[-1]["year"], spine[-1]["month"]) == (hi.year, hi.month)
    assert len(spine) == (hi.year - lo.year) * 12 + hi.month - lo.month + 1


def test_sample_sink_is_one_file(spark):
    import glob
    d = tempfile.mkdtemp(prefix="tremor-sample-", dir="/tmp") + "/s"
    ev.write_sample(spark.range(80).repartition(7), d)
    assert len(glob.glob(f"{d}/part-*.csv")) == 1


def _features(path, feats):
    with open(path, "w") as f:
        json.dump({"type": "FeatureCollection", "features": [
            {"type": "Feature", "properties": {"NAME": n}, "geometry": g} for n, g in feats]}, f)


def test_geojson_kinds_are_read_or_reported(spark, tmp_path):
    from tremor.sources.counties import geojson_report
    ring = [[0, 0], [2, 0], [2, 2], [0, 0]]
    good = [("Mix", {"type": "GeometryCollection", "geometries": [
                {"type": "Polygon", "coordinates": [ring]},
                {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}]}),
            ("None", None)]
    _features(tmp_path / "good.geojson", good)
    edges = read_geojson(spark, str(tmp_path / "good.geojson"))
    assert [tuple(r) for r in edges.groupBy("county").count().collect()] == [("Mix", 9)]
    assert edges.select("ring").distinct().count() == 3
    _features(tmp_path / "bad.geojson", good + [("Spot", {"type": "Point", "coordinates": [1, 2]})])
    path = str(tmp_path / "bad.geojson")
    with pytest.raises(Exception, match="unsupported geometry Point of Spot"):
        read_geojson(spark, path).collect()
    assert read_geojson(spark, path, unsupported="skip").count() == 9
    report = [tuple(r)[1:] for r in geojson_report(spark, path).orderBy("county").collect()]
    assert report == [("None", "none"), ("Spot", "Point")]
    # ids are the same on every read
    ids = [sorted(r[0] for r in read_geojson(spark, path, unsupported="skip")
                  .select("polygon_id").distinct().collect()) for _ in range(2)]
    assert ids[0] == ids[1] == ["bad.geojson:0"]


def test_repeated_feature_lines_are_one_polygon(spark, tmp_path):
    line = json.dumps({"type": "Feature", "properties": {"NAME": "A"}, "geometry": {
        "type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 0]]]}})
    for name in ("a", "b"):
        (tmp_path / f"{name}.geojsonl").write_text(line + "\n\n")
    edges = read_geojson(spark, str(tmp_path), line_delimited=True)
    assert edges.count() == 3


def test_stage_csv_reports_what_is_no_row(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType.fromDDL("id string, mag double, nst int, time timestamp_ntz")
    (tmp_path / "s.csv").write_text(
        "id,mag,nst,time\nev1,1.5,2,2024-01-02T03:04:05\nev2,NA,,null\n\"a,b\",2,x,\nev4,1\n"
        "ev5,1,2,2024-01-01,more\nev6,1e3,7,yesterday\n")
    good, bad = ev.read_stage_csv(spark, str(tmp_path), schema)
    assert [f.dataType for f in good.schema] == [f.dataType for f in schema]
    assert sorted(map(str, (tuple(r) for r in good.select("id", "mag", "nst").collect()))) == [
        "('ev1', 1.5, 2)", "('ev2', None, None)"]
    assert sorted((r["reason"], r["record"].split(",")[0]) for r in bad.collect()) == [
        ("malformed", "ev4"), ("malformed", "ev5"), ("nst", '"a'), ("time", "ev6")]
    assert good.where("id = 'ev4'").count() == 0 and bad.select("reason").count() == 4


def test_month_audit_scans_once(spark, sf_small, tmp_path):
    from tremor.sources.testdata import event_view
    event_view(spark, sf_small).write.parquet(str(tmp_path / "raw"))
    audit = ev.month_audit(spark.read.parquet(str(tmp_path / "raw")))
    audit.collect()
    plan = audit._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("FileScan") == 1


def test_lookup_tables_are_checked(spark):
    from tremor.operators import clean
    rows = spark.createDataFrame([("CA",), ("Ohio",)], "state string")
    own = spark.createDataFrame([("CA", "Cal")], "abbreviation string, state_name string")
    got = clean.expand_state(rows, table=own)
    assert sorted(r[0] for r in got.collect()) == ["Cal", "Ohio"]
    with pytest.raises(ValueError, match="repeats"):
        clean.expand_state(rows, table=own.union(own))

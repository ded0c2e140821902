"""Numeric conversions (P10, P11) and the lookup operators."""

import pytest
from pyspark.errors import PySparkException

from tremor.functions import fixed_values as fv
from tremor.operators import clean


def test_half_even(spark):
    vals = [0.5, 1.5, 2.5, 2.7, 3.5, -2.5, 14.5, 7.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r["x"] for r in clean.half_even_ints(df, "x").collect()]
    assert got == [0, 2, 2, 3, 4, -2, 14, 7]


def test_distance_strict_and_lenient(spark):
    df = spark.createDataFrame([("10 km",), ("8km",), ("12 km",)], "offset_distance string")
    assert [r[0] for r in clean.clean_distance(df).collect()] == [10.0, 8.0, 12.0]
    bad = spark.createDataFrame([("5 KM",)], "offset_distance string")
    assert clean.clean_distance(bad, strict=False).first()[0] is None
    with pytest.raises(PySparkException):
        clean.clean_distance(bad).collect()


def test_expand_state_case_sensitive_and_gaps(spark):
    df = spark.createDataFrame([("CA",), (" NV ",), ("ca",), ("AL",), (None,), ("Texas",)],
                               "state string")
    got = [r[0] for r in clean.expand_state(df).collect()]
    assert sorted(got, key=str) == sorted(["California", "Nevada", "ca", "AL", None, "Texas"],
                                          key=str)
    done = [r[0] for r in clean.expand_state(df.where("state = 'AL'"), complete=True).collect()]
    assert done == ["Alabama"]


def test_classify_and_region(spark):
    states = ["California", "Ohio", "Puerto Rico", "Japan", None]
    df = spark.createDataFrame([(s,) for s in states], "state string")
    got = {r["state"]: (r["country"], r["continent"])
           for r in clean.classify_country(df).collect()}
    assert got["California"] == (fv.UNITED_STATES, fv.NORTH_AMERICA)
    assert got["Ohio"] == (fv.UNKNOWN, fv.UNKNOWN)          # missing from the US list
    assert got["Puerto Rico"] == (fv.UNITED_STATES, fv.NORTH_AMERICA)
    assert got[None] == (fv.UNKNOWN, fv.UNKNOWN)
    reg = {r["state"]: r["region"] for r in clean.assign_region(df).collect()}
    assert reg["California"] == "West" and reg["Ohio"] == "Midwest"
    assert reg["Puerto Rico"] == fv.NON_US and reg["Japan"] == fv.NON_US


def test_fixed_value_sizes():
    assert len(fv.STATE_ABBREVIATIONS) == 49 and "AL" not in fv.STATE_ABBREVIATIONS
    assert len(fv.US_STATES) == 43
    assert sum(len(v) for v in fv.US_REGIONS.values()) == 50


def test_distance_rejects(spark):
    df = spark.createDataFrame([("e1", "10 km"), ("e2", "5 KM"), ("e3", "7km")],
                               "id string, offset_distance string")
    good, bad = clean.split_distance_rejects(df)
    assert sorted((r["id"], r["offset_distance"]) for r in good.collect()) == \
        [("e1", 10.0), ("e3", 7.0)]
    assert [(r["id"], r["offset_distance"]) for r in bad.collect()] == [("e2", "5 KM")]


def test_quarantine_nulls(spark):
    from tremor.operators.validate import quarantine_nulls
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "x int, y string")
    ok, bad = quarantine_nulls(df, ["x", "y"])
    assert ok.count() == 1 and bad.count() == 2


def test_lookup_tables_are_inputs(spark):
    df = spark.createDataFrame([("QC",), ("CA",)], "state string")
    abbr = spark.createDataFrame([("QC", "Quebec")], "abbreviation string, state_name string")
    got = sorted(r[0] for r in clean.expand_state(df, table=abbr).collect())
    assert got == ["CA", "Quebec"]
    reg = spark.createDataFrame([("Quebec", "East")], "state string, region string")
    assert clean.assign_region(spark.createDataFrame([("Quebec",)], "state string"),
                               table=reg).first()["region"] == "East"

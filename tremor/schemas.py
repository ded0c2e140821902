"""Fixed table layouts: raw event files, staging, the 3NF store and the star.

Types follow the warehouse DDL: free text is ``string``, measurements are
``double``, rounded counters are ``int`` and surrogate keys are ``long``.
Every read of a raw file uses ``RAW_SCHEMA``; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
TS = T.TimestampType()


def _struct(fields, nullable=True):
    return T.StructType([T.StructField(n, t, nullable) for n, t in fields])


# Raw event file (one CSV per month), in file column order.
RAW_FIELDS = [
    ("time", TS), ("latitude", D), ("longitude", D), ("depth", D), ("mag", D),
    ("magType", S), ("nst", D), ("gap", D), ("dmin", D), ("rms", D),
    ("net", S), ("id", S), ("updated", TS), ("place", S), ("type", S),
    ("horizontalError", D), ("depthError", D), ("magError", D), ("magNst", D),
    ("status", S), ("locationSource", S), ("magSource", S),
]
RAW_SCHEMA = _struct(RAW_FIELDS)
RAW_COLUMNS = [n for n, _ in RAW_FIELDS]

# Final dataset / staging table (27 columns).  ``offset_distance`` is a
# number once the " km" suffix is removed.
FINAL_COLUMNS = [
    "time", "latitude", "longitude", "depth", "mag", "magType", "nst", "gap",
    "dmin", "rms", "net", "earthquake_id", "updated", "type",
    "horizontalError", "depthError", "magError", "magNst", "status",
    "locationSource", "magSource", "offset_distance", "offset_direction",
    "nearest_locality", "state", "county", "region",
]
# Staging column types (timestamps keep the source's timestamp type).
STAGING_TYPES = {c: "double" for c in [
    "latitude", "longitude", "depth", "depthError", "horizontalError", "mag", "magError",
    "magNst", "nst", "gap", "dmin", "rms", "offset_distance"]}
STAGING_TYPES.update({c: "string" for c in [
    "earthquake_id", "status", "type", "offset_direction", "nearest_locality", "state",
    "county", "region", "magType", "net", "locationSource", "magSource"]})
STAGING_KEY = ["earthquake_id"]
# Columns the staging table declares NOT NULL.
STAGING_NOT_NULL = ["offset_distance", "offset_direction", "nearest_locality",
                    "state", "county", "region"]

# --- 3NF store -------------------------------------------------------------
LOCATION_KEY = ["offset_distance", "offset_direction", "nearest_locality",
                "state", "county", "region", "latitude", "longitude",
                "horizontal_error", "depth_error"]
MAGNITUDE_DETAIL_KEY = ["mag_type", "mag_error", "mag_nst"]
SEISMIC_METRICS_KEY = ["nst", "gap", "dmin", "rms"]
DATA_SOURCE_KEY = ["net", "location_source", "mag_source"]
EARTHQUAKE_COLUMNS = ["earthquake_id", "time", "updated", "status", "type",
                      "magnitude", "depth", "location_id", "magnitude_detail_id",
                      "seismic_metrics_id", "data_source_id"]

# --- Star schema -----------------------------------------------------------
TIME_DIM_KEY = ["full_timestamp"]
TIME_DIM_COLUMNS = ["time_id", "full_timestamp", "year", "quarter", "month", "day"]
LOCATION_DIM_KEY = ["latitude", "longitude", "nearest_locality", "state",
                    "county", "region"]
MAGNITUDE_TYPE_DIM_KEY = ["mag_type"]
DATA_SOURCE_DIM_KEY = ["net", "mag_source"]
STATUS_DIM_KEY = ["status", "type"]
FACT_COLUMNS = ["earthquake_id", "time_id", "location_id", "magnitude_type_id",
                "data_source_id", "status_id", "magnitude", "depth"]

# Table name -> (surrogate key column, natural key columns).
KEYS = {
    "location": ("location_id", LOCATION_KEY),
    "magnitude_detail": ("magnitude_detail_id", MAGNITUDE_DETAIL_KEY),
    "seismic_metrics": ("seismic_metrics_id", SEISMIC_METRICS_KEY),
    "data_source": ("data_source_id", DATA_SOURCE_KEY),
    "time_dim": ("time_id", TIME_DIM_KEY),
    "location_dim": ("location_id", LOCATION_DIM_KEY),
    "magnitude_type_dim": ("magnitude_type_id", MAGNITUDE_TYPE_DIM_KEY),
    "data_source_dim": ("data_source_id", DATA_SOURCE_DIM_KEY),
    "status_dim": ("status_id", STATUS_DIM_KEY),
}

# Foreign keys: child table -> [(column, parent table)].
FOREIGN_KEYS = {
    "earthquake": [("location_id", "location"),
                   ("magnitude_detail_id", "magnitude_detail"),
                   ("seismic_metrics_id", "seismic_metrics"),
                   ("data_source_id", "data_source")],
    "earthquake_fact": [("time_id", "time_dim"), ("location_id", "location_dim"),
                        ("magnitude_type_id", "magnitude_type_dim"),
                        ("data_source_id", "data_source_dim"),
                        ("status_id", "status_dim")],
}

# CHECK constraints of the time dimension.
TIME_DIM_RANGES = {"quarter": (1, 4), "month": (1, 12), "day": (1, 31)}

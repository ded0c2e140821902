"""DuckDB SQL oracle.

Written independently of the Spark code path: plain SQL over the driver's
views (``orders``, ``customer``), with the spatial join done by brute force
(every point against every edge) and surrogate keys by
``row_number() OVER (ORDER BY natural key)``.  Only the fixed values (lookup
lists, stand-in expressions, county polygons) and the query parameters
(``tremor.plans.params``) are shared with the library.
"""

from __future__ import annotations

from tremor.functions import fixed_values as fv
from tremor.plans.params import (BATCH_SPLIT, CLUSTER_CELL_DEG, CLUSTER_MIN_EVENTS,
                                 DENSITY_CELL_DEG, HISTOGRAM_WIDTH, MIN_MAGNITUDE,
                                 OLAP_MIN_YEAR, SAMPLE_SEED, SAMPLE_SIZE,
                                 SIGNIFICANT_MAGNITUDE, SOURCE_WINDOW)
from tremor.schemas import RAW_COLUMNS
from tremor.sources.testdata import (DIRECTIONS, FIXTURE_COUNTIES, NATION_STATE_TEXT,
                                     county_file_rings)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _values(rows) -> str:
    out = []
    for r in rows:
        out.append("(" + ", ".join(_q(v) if isinstance(v, str) else f"CAST({v!r} AS DOUBLE)"
                                   for v in r) + ")")
    return ", ".join(out)


def _edges_values() -> str:
    rows = []
    for pid, name, ring, pts in FIXTURE_COUNTIES:
        for (x1, y1), (x2, y2) in zip(pts[:-1], pts[1:]):
            rows.append((pid, name, float(x1), float(y1), float(x2), float(y2)))
    return _values(rows)


PLACE_RE = r"(?i)^(?:(\d+\s*km)\s*)?(?:([NSEW]{1,3})\s*of\s*)?([^,]+?)(?:,\s*([A-Za-z ]+))?$"
_K = "o.o_orderkey"
_C = "c.c_custkey"
_D = "CAST({} AS DOUBLE)"


def _dbl(x: str) -> str:
    return _D.format(x)


_S = f"({_list(NATION_STATE_TEXT)})[c.c_nationkey + 1]"
_DIR = f"({_list(DIRECTIONS)})[CAST({_K} % 8 AS INTEGER) + 1]"

EV = f"""ev AS (
  SELECT
    o.o_orderdate AS "time",
    {_dbl('30')} + {_dbl(f'({_C} * 37) % 1000')} / {_dbl('100')} AS latitude,
    {_dbl('-120')} + {_dbl(f'({_C} * 91) % 1000')} / {_dbl('100')} AS longitude,
    {_dbl('o.o_custkey % 40')} AS depth,
    o.o_totalprice / {_dbl('70000')} AS mag,
    CASE o.o_orderpriority WHEN '1-URGENT' THEN 'mww' WHEN '2-HIGH' THEN 'mw'
         WHEN '5-LOW' THEN 'md' ELSE 'ml' END AS "magType",
    {_dbl(f'{_K} % 60')} / {_dbl('2')} AS nst,
    {_dbl(f'({_K} % 36) * 10')} AS gap,
    CASE WHEN {_K} % 70 = 1 THEN NULL ELSE {_dbl(f'{_K} % 9')} / {_dbl('8')} END AS dmin,
    CASE WHEN {_K} % 70 = 1 THEN NULL ELSE {_dbl(f'{_K} % 7')} / {_dbl('4')} END AS rms,
    CASE c.c_mktsegment WHEN 'BUILDING' THEN 'ci' WHEN 'MACHINERY' THEN 'nn'
         WHEN 'HOUSEHOLD' THEN 'ak' ELSE 'us' END AS net,
    'ev' || CAST({_K} AS VARCHAR) AS id,
    o.o_orderdate + INTERVAL 1 DAY AS updated,
    CASE WHEN {_K} % 11 = 0 THEN {_S} || ' region'
         WHEN {_K} % 13 = 0 THEN 'S of the Fiji Islands'
         WHEN {_K} % 17 = 0 THEN '3 km N of Foo, Bar, CA'
         ELSE CAST({_K} % 97 + 1 AS VARCHAR) || ' km ' || {_DIR} || ' of ' || c.c_name
              || ', ' || {_S} END AS place,
    CASE WHEN {_K} % 20 = 0 THEN 'quarry blast' ELSE 'earthquake' END AS type,
    {_dbl(f'{_K} % 4')} / {_dbl('4')} AS "horizontalError",
    {_dbl(f'{_K} % 3')} / {_dbl('2')} AS "depthError",
    {_dbl(f'{_K} % 5')} / {_dbl('10')} AS "magError",
    CASE WHEN {_K} % 50 = 0 THEN NULL ELSE {_dbl(f'{_K} % 30')} / {_dbl('2')} END AS "magNst",
    CASE WHEN o.o_orderstatus = 'F' THEN 'reviewed' ELSE 'automatic' END AS status,
    CASE c.c_mktsegment WHEN 'BUILDING' THEN 'ci' WHEN 'MACHINERY' THEN 'nn'
         ELSE 'us' END AS "locationSource",
    CASE WHEN {_K} % 3 = 0 THEN 'us' ELSE 'nc' END AS "magSource"
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""

_NOT_NULL = " AND ".join(f'"{c}" IS NOT NULL' for c in RAW_COLUMNS)
_P = "trim(place)"
_RE = _q(PLACE_RE)


def _grp(i: int) -> str:
    return f"regexp_extract({_P}, {_RE}, {i})"


_ABBR = _values(sorted(fv.STATE_ABBREVIATIONS.items()))
_CTRY = _values([(s, fv.UNITED_STATES, fv.NORTH_AMERICA)
                 for s in fv.US_STATES + fv.US_TERRITORIES])
_REG = _values([(s, r) for r, ss in fv.US_REGIONS.items() for s in ss])

_LOC_KEY = ("offset_distance, offset_direction, nearest_locality, state, county, region, "
            "latitude, longitude, horizontal_error, depth_error")
_LOC_SEL = ("offset_distance, offset_direction, nearest_locality, state, county, region, "
            'latitude, longitude, "horizontalError" AS horizontal_error, '
            '"depthError" AS depth_error')


def _pip(points: str, key: str) -> str:
    cross = "((e.x2 - e.x1) * (t.latitude - e.y1) - (t.longitude - e.x1) * (e.y2 - e.y1))"
    return f"""
  SELECT t.{key} AS pkey, e.polygon_id, any_value(e.county) AS county
  FROM {points} t CROSS JOIN edges e
  GROUP BY t.{key}, e.polygon_id
  HAVING bool_or({cross} = 0
                 AND t.longitude BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                 AND t.latitude BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))
      OR sum(CASE WHEN (e.y1 > t.latitude) <> (e.y2 > t.latitude)
                   AND (CASE WHEN e.y2 > e.y1 THEN {cross} > 0 ELSE {cross} < 0 END)
                  THEN 1 ELSE 0 END) % 2 = 1"""


CHAIN = f"""{EV},
p1 AS (SELECT * FROM ev WHERE {_NOT_NULL}),
parsed AS (
  SELECT *,
    CASE WHEN regexp_matches({_P}, {_RE}) THEN NULLIF({_grp(1)}, '') END AS distance,
    CASE WHEN regexp_matches({_P}, {_RE}) THEN NULLIF({_grp(2)}, '') END AS direction,
    CASE WHEN regexp_matches({_P}, {_RE}) THEN trim({_grp(3)}) ELSE place END AS nearest,
    CASE WHEN regexp_matches({_P}, {_RE}) THEN NULLIF({_grp(4)}, '') END AS state
  FROM p1),
parsed_ok AS (SELECT * FROM parsed WHERE distance IS NOT NULL AND direction IS NOT NULL
              AND nearest IS NOT NULL AND state IS NOT NULL),
abbr(abbreviation, state_name) AS (VALUES {_ABBR}),
ctry(cstate, country, continent) AS (VALUES {_CTRY}),
reg(rstate, region) AS (VALUES {_REG}),
edges(polygon_id, county, x1, y1, x2, y2) AS (VALUES {_edges_values()}),
expanded AS (
  SELECT p.* REPLACE (COALESCE(a.state_name, trim(p.state)) AS state)
  FROM parsed_ok p LEFT JOIN abbr a ON a.abbreviation = trim(p.state)),
classified AS (
  SELECT e.*, COALESCE(c.country, 'Unknown') AS country,
         COALESCE(c.continent, 'Unknown') AS continent
  FROM expanded e LEFT JOIN ctry c ON c.cstate = trim(e.state)),
transformed AS (
  SELECT "time", latitude, longitude, depth, mag, "magType", nst, gap, dmin, rms, net,
         id AS earthquake_id, updated, type, "horizontalError", "depthError", "magError",
         "magNst", status, "locationSource", "magSource", distance AS offset_distance,
         direction AS offset_direction, nearest AS nearest_locality, state, country, continent
  FROM classified WHERE continent <> 'Unknown' AND country = 'United States'),
pip_us AS ({_pip('transformed', 'earthquake_id')}),
with_county AS (
  SELECT t.*, p.county FROM transformed t LEFT JOIN pip_us p ON p.pkey = t.earthquake_id),
final AS (
  SELECT w.* EXCLUDE (country, continent, offset_distance),
         CAST(regexp_replace(w.offset_distance, '\\s*km', '', 'g') AS DOUBLE) AS offset_distance,
         r.region
  FROM with_county w JOIN reg r ON r.rstate = w.state
  WHERE w.county IS NOT NULL),
staging AS (
  SELECT * FROM final
  QUALIFY row_number() OVER (PARTITION BY earthquake_id ORDER BY "time", county) = 1),
staged AS (
  SELECT *, CAST("magNst" AS INTEGER) AS mag_nst, CAST(nst AS INTEGER) AS nst_count,
         dense_rank() OVER (ORDER BY offset_distance, offset_direction, nearest_locality, state,
                            county, region, latitude, longitude, "horizontalError", "depthError")
           AS place_no,
         dense_rank() OVER (ORDER BY "magType", "magError", CAST("magNst" AS INTEGER)) AS detail_no,
         dense_rank() OVER (ORDER BY CAST(nst AS INTEGER), gap, dmin, rms) AS metric_no,
         dense_rank() OVER (ORDER BY net, "locationSource", "magSource") AS source_no,
         dense_rank() OVER (ORDER BY "time") AS time_no,
         dense_rank() OVER (ORDER BY latitude, longitude, nearest_locality, state, county, region)
           AS spot_no,
         dense_rank() OVER (ORDER BY "magType") AS type_no,
         dense_rank() OVER (ORDER BY net, "magSource") AS net_no,
         dense_rank() OVER (ORDER BY status, type) AS status_no
  FROM staging),
location AS (SELECT DISTINCT place_no AS location_id, {_LOC_SEL} FROM staged),
magnitude_detail AS (
  SELECT DISTINCT detail_no AS magnitude_detail_id, "magType" AS mag_type,
         "magError" AS mag_error, mag_nst FROM staged),
seismic_metrics AS (
  SELECT DISTINCT metric_no AS seismic_metrics_id, nst_count AS nst, gap, dmin, rms FROM staged),
data_source AS (
  SELECT DISTINCT source_no AS data_source_id, net, "locationSource" AS location_source,
         "magSource" AS mag_source FROM staged),
earthquake AS (
  SELECT earthquake_id, "time", updated, status, type, mag AS magnitude, depth,
         place_no AS location_id, detail_no AS magnitude_detail_id,
         metric_no AS seismic_metrics_id, source_no AS data_source_id FROM staged),
time_dim AS (
  SELECT DISTINCT time_no AS time_id, "time" AS full_timestamp,
         CAST(year("time") AS INTEGER) AS year, CAST(quarter("time") AS INTEGER) AS quarter,
         CAST(month("time") AS INTEGER) AS month, CAST(day("time") AS INTEGER) AS day FROM staged),
location_dim AS (
  SELECT DISTINCT spot_no AS location_id, latitude, longitude, nearest_locality, state, county,
         region FROM staged),
magnitude_type_dim AS (
  SELECT DISTINCT type_no AS magnitude_type_id, "magType" AS mag_type FROM staged),
data_source_dim AS (
  SELECT DISTINCT net_no AS data_source_id, net, "magSource" AS mag_source FROM staged),
status_dim AS (SELECT DISTINCT status_no AS status_id, status, type FROM staged),
earthquake_fact AS (
  SELECT earthquake_id, time_no AS time_id, spot_no AS location_id, type_no AS magnitude_type_id,
         net_no AS data_source_id, status_no AS status_id, mag AS magnitude, depth FROM staged)"""


def _with(select: str, extra: str = "") -> str:
    """The whole CTE chain, optional extra CTEs, then the query."""
    more = f",\n{extra.strip()}" if extra else ""
    return f"WITH {CHAIN}{more}\n{select}"


# Column lists of the warehouse tables (from the table definitions).
TABLE_COLUMNS = {
    "location": ["location_id", "offset_distance", "offset_direction", "nearest_locality",
                 "state", "county", "region", "latitude", "longitude", "horizontal_error",
                 "depth_error"],
    "magnitude_detail": ["magnitude_detail_id", "mag_type", "mag_error", "mag_nst"],
    "seismic_metrics": ["seismic_metrics_id", "nst", "gap", "dmin", "rms"],
    "data_source": ["data_source_id", "net", "location_source", "mag_source"],
    "earthquake": ["earthquake_id", "time", "updated", "status", "type", "magnitude", "depth",
                   "location_id", "magnitude_detail_id", "seismic_metrics_id",
                   "data_source_id"],
    "time_dim": ["time_id", "full_timestamp", "year", "quarter", "month", "day"],
    "location_dim": ["location_id", "latitude", "longitude", "nearest_locality", "state",
                     "county", "region"],
    "magnitude_type_dim": ["magnitude_type_id", "mag_type"],
    "data_source_dim": ["data_source_id", "net", "mag_source"],
    "status_dim": ["status_id", "status", "type"],
    "earthquake_fact": ["earthquake_id", "time_id", "location_id", "magnitude_type_id",
                        "data_source_id", "status_id", "magnitude", "depth"],
}
NATURAL_KEYS = {
    "location": ("location_id", "offset_distance, offset_direction, nearest_locality, state, "
                 "county, region, latitude, longitude, horizontal_error, depth_error"),
    "magnitude_detail": ("magnitude_detail_id", "mag_type, mag_error, mag_nst"),
    "seismic_metrics": ("seismic_metrics_id", "nst, gap, dmin, rms"),
    "data_source": ("data_source_id", "net, location_source, mag_source"),
    "time_dim": ("time_id", "full_timestamp"),
    "location_dim": ("location_id", "latitude, longitude, nearest_locality, state, county, "
                     "region"),
    "magnitude_type_dim": ("magnitude_type_id", "mag_type"),
    "data_source_dim": ("data_source_id", "net, mag_source"),
    "status_dim": ("status_id", "status, type"),
}
FOREIGN_KEYS = [
    ("earthquake", "location_id", "location", "location_id"),
    ("earthquake", "magnitude_detail_id", "magnitude_detail", "magnitude_detail_id"),
    ("earthquake", "seismic_metrics_id", "seismic_metrics", "seismic_metrics_id"),
    ("earthquake", "data_source_id", "data_source", "data_source_id"),
    ("earthquake_fact", "time_id", "time_dim", "time_id"),
    ("earthquake_fact", "location_id", "location_dim", "location_id"),
    ("earthquake_fact", "magnitude_type_id", "magnitude_type_dim", "magnitude_type_id"),
    ("earthquake_fact", "data_source_id", "data_source_dim", "data_source_id"),
    ("earthquake_fact", "status_id", "status_dim", "status_id"),
]


def _unique_checks() -> str:
    checks = [("staging_events", "staging", "earthquake_id")]
    checks += [(t, t, idc) for t, (idc, _) in NATURAL_KEYS.items()]
    checks += [(t, t, key) for t, (_, key) in NATURAL_KEYS.items()]
    checks += [("earthquake", "earthquake", "earthquake_id"),
               ("earthquake_fact", "earthquake_fact", "earthquake_id")]
    parts = []
    for name, cte, key in checks:
        kc = ",".join(k.strip() for k in key.split(","))
        parts.append(
            f"SELECT {_q(name)} AS table_name, {_q(kc)} AS key_columns, "
            f"CAST(count(*) AS BIGINT) AS duplicate_keys, "
            f"CAST(COALESCE(sum(n), 0) AS BIGINT) AS duplicate_rows "
            f"FROM (SELECT count(*) AS n FROM {cte} GROUP BY {key} HAVING count(*) > 1)")
    return "\nUNION ALL ".join(parts)


def _not_null_checks() -> str:
    parts = []
    for t, cols in TABLE_COLUMNS.items():
        for c in cols:
            parts.append(f"SELECT {_q(t)} AS table_name, {_q(c)} AS column_name, "
                         f"CAST(count_if(\"{c}\" IS NULL) AS BIGINT) AS nulls FROM {t}")
    return "\nUNION ALL ".join(parts)


def _ref_checks() -> str:
    parts = []
    for child, col, parent, pk in FOREIGN_KEYS:
        parts.append(
            f"SELECT {_q(child)} AS child_table, {_q(col)} AS column_name, "
            f"{_q(parent)} AS parent_table, CAST(count(*) AS BIGINT) AS orphans "
            f"FROM {child} c WHERE NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{pk} = c.{col})")
    return "\nUNION ALL ".join(parts)


def _counts(dim: str, k: int | None = None) -> str:
    sql = (f'SELECT "{dim}", CAST(count(*) AS BIGINT) AS n FROM final '
           f'WHERE "{dim}" IS NOT NULL GROUP BY "{dim}"')
    if k:
        sql += f' ORDER BY n DESC, "{dim}" LIMIT {k}'
    return _with(sql)


_CATS = ["region", "state", "county", "magType", "status"]
_CATEGORY_COUNTS = "\nUNION ALL ".join(
    f"SELECT {_q(d)} AS dimension, CAST(\"{d}\" AS VARCHAR) AS value, "
    f"CAST(count(*) AS BIGINT) AS n FROM final WHERE \"{d}\" IS NOT NULL GROUP BY \"{d}\""
    for d in _CATS)

_MAG = ("round(min(mag), 6) AS mag_min, round(max(mag), 6) AS mag_max, "
        "round(avg(mag), 6) AS mag_mean, round(stddev_samp(mag), 6) AS mag_std, "
        "CAST(count_if(mag > 5.0) AS BIGINT) AS mag_over_5, "
        "CAST(count_if(mag > 6.0) AS BIGINT) AS mag_over_6")
_DEPTH = ("round(min(depth), 6) AS depth_min, round(max(depth), 6) AS depth_max, "
          "round(avg(depth), 6) AS depth_mean, "
          "CAST(count_if(depth < 10.0) AS BIGINT) AS depth_under_10")
_TIME = ("strftime(min(\"time\"), '%Y-%m-%d') AS time_start, "
         "strftime(max(\"time\"), '%Y-%m-%d') AS time_end")
_GEO = ("min(latitude) AS lat_min, max(latitude) AS lat_max, "
        "min(longitude) AS lon_min, max(longitude) AS lon_max")

_FINALS = ("CAST(count(*) AS BIGINT) AS earthquake_count, "
           "round(sum(f.magnitude), 6) AS sum_magnitude, max(f.magnitude) AS max_magnitude, "
           "CAST(count_if(f.magnitude > 5.0) AS BIGINT) AS major_earthquakes")

_TS_LO, _TS_HI = SOURCE_WINDOW


def _loc_batches() -> str:
    return _with("SELECT * FROM b1 UNION ALL SELECT * FROM b2", f"""
b1 AS (
  SELECT row_number() OVER (ORDER BY {_LOC_KEY}) AS location_id, *
  FROM (SELECT DISTINCT {_LOC_SEL} FROM staging
        WHERE "time" < CAST({_q(BATCH_SPLIT)} AS TIMESTAMP))),
b2 AS (
  SELECT (SELECT COALESCE(max(location_id), 0) FROM b1)
         + row_number() OVER (ORDER BY {_LOC_KEY}) AS location_id, *
  FROM (SELECT DISTINCT {_LOC_SEL} FROM staging
        EXCEPT SELECT {_LOC_KEY} FROM b1))""")


_SAMPLED = f"""SELECT * FROM final
ORDER BY md5(earthquake_id || ':{SAMPLE_SEED}'), earthquake_id, "time", latitude, longitude, county"""


def _county_file_edges() -> str:
    return _values([(n, n, float(a[0]), float(a[1]), float(b[0]), float(b[1]))
                    for n, ring in county_file_rings() for a, b in zip(ring, ring[1:])])


def _clusters() -> str:
    touching = "abs(p.y - q.y) <= 1 AND abs(p.x - q.x) <= 1"
    return "WITH RECURSIVE " + _with("""
SELECT c.y AS lat_cell, c.x AS lon_cell, CAST(c.n AS BIGINT) AS n_events,
       CASE WHEN own.root IS NOT NULL THEN 'core' WHEN edge.root IS NOT NULL THEN 'border'
            ELSE 'noise' END AS role,
       CASE WHEN coalesce(own.root, edge.root) IS NOT NULL THEN
         CAST(coalesce(own.root, edge.root)[1] AS VARCHAR) || ':'
         || CAST(coalesce(own.root, edge.root)[2] AS VARCHAR) END AS cluster
FROM cells c
LEFT JOIN roots own ON own.y = c.y AND own.x = c.x
LEFT JOIN (SELECT p.y, p.x, min(q.root) AS root FROM cells p JOIN roots q ON """ + touching + """
           GROUP BY p.y, p.x) edge ON edge.y = c.y AND edge.x = c.x""", f"""
cells AS (
  SELECT CAST(floor(latitude / {CLUSTER_CELL_DEG}) AS BIGINT) AS y,
         CAST(floor(longitude / {CLUSTER_CELL_DEG}) AS BIGINT) AS x, count(*) AS n
  FROM final WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2),
core AS (SELECT p.y, p.x FROM cells p JOIN cells q ON {touching}
         GROUP BY p.y, p.x HAVING sum(q.n) >= {CLUSTER_MIN_EVENTS}),
reach(y, x, ry, rx) AS (
  SELECT y, x, y, x FROM core
  UNION
  SELECT p.y, p.x, q.ry, q.rx FROM core p JOIN reach q ON {touching}),
roots AS (SELECT y, x, min([ry, rx]) AS root FROM reach GROUP BY y, x)""")[len("WITH "):]


def _star_rows(kept: str) -> str:
    return _with(f"""
SELECT earthquake_id, "time" AS full_timestamp, updated, state, county, latitude, longitude,
       mag AS magnitude, depth, gap FROM ({kept})""")


def _stage_audit_observed() -> str:
    stages = [("raw", "ev"), ("complete", "p1"), ("place_parsed", "parsed_ok"),
              ("united_states", "transformed"),
              ("us_regions", "transformed t JOIN reg r ON r.rstate = t.state"),
              ("with_county", "final"), ("final", "final")]
    parts = [f"SELECT {_q(n)} AS stage, {i} AS position, CAST(count(*) AS BIGINT) AS n_rows "
             f"FROM {t}" for i, (n, t) in enumerate(stages)]
    return _with("\nUNION ALL ".join(parts))


def _completeness() -> str:
    parts = [f"SELECT {_q(c)} AS column_name, CAST(count(\"{c}\") AS BIGINT) AS non_null, "
             f"CAST(count(*) AS BIGINT) AS total_rows, "
             f"round(CAST(count(\"{c}\") AS DOUBLE) / count(*), 6) AS completeness FROM ev"
             for c in RAW_COLUMNS]
    return _with("\nUNION ALL ".join(parts))


def _stage_audit() -> str:
    stages = [("raw", "ev", 22), ("complete", "p1", 22), ("place_parsed", "parsed_ok", 26),
              ("united_states", "transformed", 27), ("with_county", "with_county", 28),
              ("final", "final", 27)]
    parts = [f"SELECT {_q(n)} AS stage, {i} AS position, CAST(count(*) AS BIGINT) AS n_rows, "
             f"{k} AS n_columns FROM {t}" for i, (n, t, k) in enumerate(stages)]
    return _with("\nUNION ALL ".join(parts))


ORACLE_SQL: dict[str, str] = {
    "month_spine": _with("""
SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month,
       CAST(m AS DATE) AS month_start, CAST(last_day(m) AS DATE) AS month_end
FROM (SELECT unnest(generate_series(date_trunc('month', min("time")),
                                    date_trunc('month', max("time")), INTERVAL 1 MONTH)) AS m
      FROM ev)"""),
    "month_audit": _with("""
SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month,
       CAST(COALESCE(c.n, 0) AS BIGINT) AS n_events
FROM (SELECT unnest(generate_series(date_trunc('month', min("time")),
                                    date_trunc('month', max("time")), INTERVAL 1 MONTH)) AS m
      FROM ev) s
LEFT JOIN (SELECT year("time") AS y, month("time") AS mo, count(*) AS n FROM ev
           WHERE "time" IS NOT NULL GROUP BY 1, 2) c
  ON c.y = year(s.m) AND c.mo = month(s.m)"""),
    "source_filter": _with(f"""
SELECT * FROM ev WHERE "time" >= CAST({_q(_TS_LO)} AS TIMESTAMP)
  AND "time" < CAST({_q(_TS_HI)} AS TIMESTAMP) AND mag >= {MIN_MAGNITUDE}"""),
    "union_months": _with("SELECT * FROM ev"),
    "stage_roundtrip": _with("SELECT * FROM final"),
    "stage_restart_csv": _with("SELECT * FROM with_county"),
    "stage_rejects_csv": _with("""
SELECT 'accepted' AS reason, CAST(count(*) AS BIGINT) AS n FROM with_county
UNION ALL SELECT 'malformed', 1 UNION ALL SELECT 'mag', 1"""),
    "sample_n": _with(f"{_SAMPLED} LIMIT {SAMPLE_SIZE}"),
    "sample_csv": _with(f"{_SAMPLED} LIMIT {SAMPLE_SIZE}"),
    "sample_json": _with(f"""
SELECT * REPLACE (strftime("time", '%Y-%m-%d %H:%M:%S') AS "time",
                  strftime(updated, '%Y-%m-%d %H:%M:%S') AS updated) FROM ({_SAMPLED} LIMIT 6)"""),
    "county_file_join": _with(f"""
SELECT pkey AS id, county FROM ({_pip('ev', 'id').replace('edges e', 'file_edges e')})""", f"""
file_edges(polygon_id, county, x1, y1, x2, y2) AS (VALUES {_county_file_edges()})"""),
    "spatial_clusters": _clusters(),
    "dropna_any": _with("SELECT * FROM p1"),
    "parse_place": _with("SELECT id, place, distance, direction, nearest, state FROM parsed"),
    "expand_state": _with("SELECT id, state FROM expanded"),
    "classify_country": _with("SELECT id, state, country, continent FROM classified"),
    "us_filter": _with("SELECT id, state, country, continent FROM classified "
                       "WHERE continent <> 'Unknown' AND country = 'United States'"),
    "assign_region": _with("SELECT t.earthquake_id, t.state, r.region FROM transformed t "
                           "JOIN reg r ON r.rstate = t.state"),
    "clean_distance": _with("SELECT earthquake_id, CAST(regexp_replace(offset_distance, "
                            "'\\s*km', '', 'g') AS DOUBLE) AS offset_distance FROM transformed"),
    "cast_half_even": _with('SELECT id, CAST("magNst" AS INTEGER) AS mag_nst, '
                            'CAST(nst AS INTEGER) AS nst FROM p1'),
    "clean_pipeline": _with("SELECT * FROM transformed"),
    "county_join": _with("SELECT * FROM with_county"),
    "county_multi_match": _with("""
SELECT earthquake_id, CAST(count(DISTINCT county) AS BIGINT) AS n_counties,
       string_agg(DISTINCT county, ',' ORDER BY county) AS counties
FROM with_county WHERE county IS NOT NULL GROUP BY earthquake_id
HAVING count(DISTINCT county) > 1"""),
    "point_in_polygon": _with(f"SELECT pkey AS id, county FROM ({_pip('ev', 'id')})"),
    "final_dataset": _with("SELECT * FROM final"),
    "staging_events": _with("SELECT * FROM staging"),
    "load_location": _with("SELECT * FROM location"),
    "load_magnitude_detail": _with("SELECT * FROM magnitude_detail"),
    "load_seismic_metrics": _with("SELECT * FROM seismic_metrics"),
    "load_data_source": _with("SELECT * FROM data_source"),
    "load_event": _with("SELECT * FROM earthquake"),
    "load_time_dim": _with("SELECT * FROM time_dim"),
    "load_location_dim": _with("SELECT * FROM location_dim"),
    "load_magnitude_type_dim": _with("SELECT * FROM magnitude_type_dim"),
    "load_data_source_dim": _with("SELECT * FROM data_source_dim"),
    "load_status_dim": _with("SELECT * FROM status_dim"),
    "load_fact": _with("SELECT * FROM earthquake_fact"),
    "upsert_insert_only": _loc_batches(),
    "upsert_revised": _star_rows(f"""
  SELECT * FROM staging WHERE "time" < CAST({_q(BATCH_SPLIT)} AS TIMESTAMP)
  UNION ALL
  SELECT * REPLACE (mag + 1 AS mag, gap + 1 AS gap, updated + INTERVAL 40 DAY AS updated,
                    "time" + INTERVAL 40 DAY AS "time")
  FROM staging WHERE "time" >= CAST({_q(BATCH_SPLIT)} AS TIMESTAMP)"""),
    "upsert_duplicates": _star_rows("SELECT * FROM staging"),
    "check_unique": _with(_unique_checks()),
    "check_not_null": _with(_not_null_checks()),
    "quarantine_nulls": _with(f"SELECT * FROM ev WHERE NOT ({_NOT_NULL})"),
    "check_range": _with("""
SELECT 'time_dim' AS table_name, 'quarter' AS column_name,
       CAST(count_if(NOT quarter BETWEEN 1 AND 4) AS BIGINT) AS violations FROM time_dim
UNION ALL SELECT 'time_dim', 'month', CAST(count_if(NOT month BETWEEN 1 AND 12) AS BIGINT)
  FROM time_dim
UNION ALL SELECT 'time_dim', 'day', CAST(count_if(NOT day BETWEEN 1 AND 31) AS BIGINT)
  FROM time_dim"""),
    "check_refs": _with(_ref_checks()),
    "category_counts": _with(_CATEGORY_COUNTS),
    "top_per_category": _with(f"""
SELECT dimension, value, n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY n DESC, value) AS rank
  FROM ({_CATEGORY_COUNTS})) WHERE rank <= 3"""),
    "region_counts": _counts("region"),
    "state_top10": _counts("state", 10),
    "county_top10": _counts("county", 10),
    "county_top5": _counts("county", 5),
    "mag_type_counts": _counts("magType"),
    "status_counts": _counts("status"),
    "mag_summary": _with(f"SELECT {_MAG} FROM final"),
    "depth_summary": _with(f"SELECT {_DEPTH} FROM final"),
    "time_range": _with(f"SELECT {_TIME} FROM final"),
    "yearly_counts": _with('SELECT CAST(year("time") AS INTEGER) AS year, '
                           'CAST(count(*) AS BIGINT) AS n FROM final GROUP BY 1'),
    "geo_range": _with(f"SELECT {_GEO} FROM final"),
    "stage_audit": _stage_audit(),
    "stage_audit_observed": _stage_audit_observed(),
    "profile": _with(f"SELECT CAST(count(*) AS BIGINT) AS n_rows, 27 AS n_columns, "
                     f"{_MAG}, {_DEPTH}, {_TIME}, {_GEO} FROM final"),
    # Star answers straight from staging: no key of the warehouse takes part.
    "olap_top_states": _with("""
SELECT state, CAST(count(*) AS BIGINT) AS earthquake_count
FROM staging GROUP BY state ORDER BY earthquake_count DESC, state LIMIT 10"""),
    "olap_monthly": _with("""
SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month, n AS earthquake_count,
       round(total / n, 6) AS avg_magnitude
FROM (SELECT date_trunc('month', "time") AS m, CAST(count(*) AS BIGINT) AS n, sum(mag) AS total
      FROM staging GROUP BY 1)"""),
    "olap_regions": _with(f"""
SELECT region, CAST(sum(n) AS BIGINT) AS total_earthquakes,
       round(sum(total) / sum(n), 6) AS avg_magnitude, max(top) AS max_magnitude,
       CAST(sum(big) AS BIGINT) AS major_earthquakes
FROM (SELECT region, year("time") AS y, count(*) AS n, sum(mag) AS total, max(mag) AS top,
             count_if(mag > 5.0) AS big FROM staging GROUP BY 1, 2)
WHERE y >= {OLAP_MIN_YEAR} GROUP BY region"""),
    "rollup_geo": _with(f"""
SELECT l.region, l.state, l.county,
       CAST(GROUPING(l.region, l.state, l.county) AS BIGINT) AS grouping_level, {_FINALS}
FROM earthquake_fact f JOIN location_dim l ON f.location_id = l.location_id
GROUP BY ROLLUP (l.region, l.state, l.county)"""),
    "rollup_time": _with(f"""
SELECT t.year, t.quarter, t.month, t.day,
       CAST(GROUPING(t.year, t.quarter, t.month, t.day) AS BIGINT) AS grouping_level,
       {_FINALS}
FROM earthquake_fact f JOIN time_dim t ON f.time_id = t.time_id
GROUP BY ROLLUP (t.year, t.quarter, t.month, t.day)"""),
    "drill_down": _with(f"""
SELECT l.region, l.state, {_FINALS}
FROM earthquake_fact f JOIN location_dim l ON f.location_id = l.location_id
WHERE l.region = 'West' GROUP BY l.region, l.state"""),
    "drill_down_county": _with(f"""
SELECT l.region, l.state, l.county, {_FINALS}
FROM earthquake_fact f JOIN location_dim l ON f.location_id = l.location_id
WHERE l.region = 'West' AND l.state = 'California' GROUP BY l.region, l.state, l.county"""),
    "drill_down_time": _with(f"""
SELECT t.year, t.month, t.day, {_FINALS}
FROM earthquake_fact f JOIN time_dim t ON f.time_id = t.time_id
WHERE t.year = 1997 AND t.month = 3 GROUP BY t.year, t.month, t.day"""),
    "slice_dice": _with(f"""
SELECT l.region, l.state, {_FINALS}
FROM earthquake_fact f JOIN location_dim l ON f.location_id = l.location_id
WHERE f.magnitude >= 3.0 AND f.magnitude < 6.0 AND f.depth < 20.0
  AND l.region IN ('West', 'South')
GROUP BY l.region, l.state"""),
    "cube_cross": _with(f"""
SELECT l.region, m.mag_type, CAST(GROUPING(l.region, m.mag_type) AS BIGINT) AS grouping_level,
       {_FINALS}
FROM earthquake_fact f JOIN location_dim l ON f.location_id = l.location_id
JOIN magnitude_type_dim m ON f.magnitude_type_id = m.magnitude_type_id
GROUP BY CUBE (l.region, m.mag_type)"""),
    "pivot_cross": _with("""
SELECT l.region,
       CAST(count(*) FILTER (WHERE m.mag_type = 'md') AS BIGINT) AS md,
       CAST(count(*) FILTER (WHERE m.mag_type = 'ml') AS BIGINT) AS ml,
       CAST(count(*) FILTER (WHERE m.mag_type = 'mw') AS BIGINT) AS mw,
       CAST(count(*) FILTER (WHERE m.mag_type = 'mww') AS BIGINT) AS mww
FROM earthquake_fact f JOIN location_dim l ON f.location_id = l.location_id
JOIN magnitude_type_dim m ON f.magnitude_type_id = m.magnitude_type_id
GROUP BY l.region"""),
    "mag_histogram": _with(f"""
SELECT CAST(floor(mag / {HISTOGRAM_WIDTH}) AS BIGINT) * {HISTOGRAM_WIDTH} AS bin_start,
       CAST(count(*) AS BIGINT) AS n
FROM final WHERE mag IS NOT NULL GROUP BY 1"""),
    "mag_depth_corr": _with("""
SELECT CAST(count(*) AS BIGINT) AS n, round(corr(mag, depth), 6) AS corr_mag_depth,
       round(covar_samp(mag, depth), 6) AS covar_mag_depth FROM final"""),
    "depth_bands": _with("""
SELECT CAST(floor(depth / 10.0) AS BIGINT) * 10.0 AS depth_band, CAST(count(*) AS BIGINT) AS n,
       round(sum(mag), 6) AS sum_magnitude
FROM final WHERE depth IS NOT NULL AND mag IS NOT NULL GROUP BY 1"""),
    "density_grid": _with(f"""
SELECT CAST(floor(latitude / {DENSITY_CELL_DEG}) AS BIGINT) AS lat_cell,
       CAST(floor(longitude / {DENSITY_CELL_DEG}) AS BIGINT) AS lon_cell,
       CAST(count(*) AS BIGINT) AS n_events
FROM final WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2"""),
    "calendar": _with("""
SELECT d.day, CAST(year(d.day) AS INTEGER) AS year, CAST(month(d.day) AS INTEGER) AS month,
       CAST(dayofweek(d.day) + 1 AS INTEGER) AS day_of_week,
       CAST(COALESCE(c.n, 0) AS BIGINT) AS n_events
FROM days d LEFT JOIN counts c ON c.day = d.day""", """
days AS (
  SELECT CAST(d AS DATE) AS day FROM (
    SELECT unnest(generate_series(CAST(min("time") AS DATE), CAST(max("time") AS DATE),
                                  INTERVAL 1 DAY)) AS d FROM final)),
counts AS (SELECT CAST("time" AS DATE) AS day, count(*) AS n FROM final GROUP BY 1)"""),
    "seasonal": _with('SELECT CAST(month("time") AS INTEGER) AS month, '
                      'CAST(count(*) AS BIGINT) AS n_events FROM final GROUP BY 1'),
    "significant": _with(f"SELECT * FROM final WHERE mag > {SIGNIFICANT_MAGNITUDE}"),
    "completeness": _completeness(),
    "monthly_change": _with("""
SELECT region, year, month, earthquake_count,
       lag(earthquake_count) OVER w AS previous_count,
       earthquake_count - lag(earthquake_count) OVER w AS change,
       round((earthquake_count - lag(earthquake_count) OVER w)
             / lag(earthquake_count) OVER w, 6) AS change_ratio
FROM monthly WINDOW w AS (PARTITION BY region ORDER BY year, month)""", """
monthly AS (
  SELECT l.region, t.year, t.month, CAST(count(*) AS BIGINT) AS earthquake_count
  FROM earthquake_fact f JOIN location_dim l ON f.location_id = l.location_id
  JOIN time_dim t ON f.time_id = t.time_id GROUP BY l.region, t.year, t.month)"""),
    "quantiles": _with("""
SELECT l.region, CAST(count(*) AS BIGINT) AS n,
       quantile_disc(f.magnitude, 0.0) AS q_min, quantile_disc(f.magnitude, 0.25) AS q1,
       quantile_disc(f.magnitude, 0.5) AS median, quantile_disc(f.magnitude, 0.75) AS q3,
       quantile_disc(f.magnitude, 1.0) AS q_max
FROM earthquake_fact f JOIN location_dim l ON f.location_id = l.location_id
GROUP BY l.region"""),
    "source_quality": _with("""
SELECT ds.net, ds.mag_source, CAST(count(*) AS BIGINT) AS n_events,
       round(avg(m.mag_error), 6) AS avg_mag_error, round(avg(sm.rms), 6) AS avg_rms,
       round(avg(sm.gap), 6) AS avg_gap, max(e.updated) AS last_updated
FROM earthquake e JOIN data_source ds ON e.data_source_id = ds.data_source_id
JOIN magnitude_detail m ON e.magnitude_detail_id = m.magnitude_detail_id
JOIN seismic_metrics sm ON e.seismic_metrics_id = sm.seismic_metrics_id
GROUP BY ds.net, ds.mag_source"""),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)

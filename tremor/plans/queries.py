"""Registered queries: one per operator of the survey, each ``(spark, sf_dir) -> DataFrame``.

All of them read the driver's test tables through the stand-in event view
(``tremor.sources.testdata``) and run over whole tables.  As in the
reference, the pipeline writes the final dataset file once per (session,
folder) (``final_stage``); staging is loaded from it and the analysis
queries read it.  Warehouse queries share one published warehouse per
(session, folder): the loads run once (they write tables), and each load
query returns the table it produced.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor import schemas as S
from tremor.operators import clean, clusters, olap, profile, spatial, validate
from tremor.plans import pipeline
from tremor.plans.warehouse import Warehouse
from tremor.session import release, scratch_path
from tremor.sources import counties as cty
from tremor.sources import events as ev
from tremor.functions.tables import local_table
from tremor.sources.testdata import event_view, fixture_county_edges, write_county_file

from tremor.plans.params import (BATCH_SPLIT, CLUSTER_CELL_DEG, CLUSTER_MIN_EVENTS,
                                 DENSITY_CELL_DEG, HISTOGRAM_WIDTH, MIN_MAGNITUDE,
                                 OLAP_MIN_YEAR, SAMPLE_SEED, SAMPLE_SIZE,
                                 SIGNIFICANT_MAGNITUDE, SOURCE_WINDOW)

_WAREHOUSES: dict[tuple[int, str], Warehouse] = {}
_WAREHOUSE_LOCK = threading.Lock()
_FINAL_STAGES: dict[tuple[int, str], str] = {}
_FINAL_STAGE_LOCK = threading.Lock()


def raw(spark, sf) -> DataFrame:
    return event_view(spark, sf)


def edges(spark) -> DataFrame:
    return fixture_county_edges(spark)


def transformed(spark, sf) -> DataFrame:
    return pipeline.transformed_events(raw(spark, sf))


def final(spark, sf) -> DataFrame:
    return pipeline.final_dataset(raw(spark, sf), edges(spark))


def final_stage(spark: SparkSession, sf: str) -> DataFrame:
    """S7 then S6: the final dataset written once per (session, folder) and read back.

    The analysis queries (profile, counts, histograms, calendar...) read this
    stage file, as the reference's analysis step reads the final dataset
    file, instead of re-running the pipeline for every question.
    """
    key = (id(spark._jsparkSession), sf)
    with _FINAL_STAGE_LOCK:
        path = _FINAL_STAGES.get(key)
        if path is None:
            path = scratch_path(spark, "final_stage")
            ev.write_stage(final(spark, sf), path)
            release(spark)
            _FINAL_STAGES[key] = path
    return ev.read_stage(spark, path)


def staging(spark, sf) -> DataFrame:
    """S9 loaded from the final dataset file, as the reference loads staging."""
    return pipeline.staging_from_final(final_stage(spark, sf))


def warehouse(spark: SparkSession, sf: str) -> Warehouse:
    """The published warehouse of ``sf`` for this session (built on first use)."""
    key = (id(spark._jsparkSession), sf)
    with _WAREHOUSE_LOCK:
        wh = _WAREHOUSES.get(key)
        if wh is None:
            wh = Warehouse(spark).load_all(staging(spark, sf))
            _WAREHOUSES[key] = wh
    return wh


def _t(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark, sf):
        return warehouse(spark, sf).table(name)
    q.__name__ = f"load_{name}"
    return q


# --- sources -------------------------------------------------------------------

def q_month_spine(spark, sf):
    return ev.month_spine_of(raw(spark, sf)).select(
        "year", "month", "month_start", "month_end")


def q_month_audit(spark, sf):
    return ev.month_audit(raw(spark, sf))


def q_source_filter(spark, sf):
    return ev.source_filter(raw(spark, sf), *SOURCE_WINDOW, MIN_MAGNITUDE)


def q_union_months(spark, sf):
    """S7 month-partitioned CSV write, then S1/S4 scan of all months back."""
    root = scratch_path(spark, "raw_months")
    ev.write_months(raw(spark, sf), root)
    back = ev.read_months(spark, root)
    return back.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in ("time", "updated")
                         else F.col(c) for c in S.RAW_COLUMNS])


def q_stage_roundtrip(spark, sf):
    """S7 then S5/S6: the final dataset written as a stage file and read back."""
    path = scratch_path(spark, "final_stage")
    ev.write_stage(final(spark, sf), path)
    return ev.read_stage(spark, path)


def q_sample_csv(spark, sf):
    """The 80-row sample written as one CSV file of all columns and read back."""
    path = scratch_path(spark, "sample")
    sample = profile.sample_rows(final_stage(spark, sf), SAMPLE_SIZE, seed=SAMPLE_SEED)
    ev.write_sample(sample, path)
    return ev.read_stage_csv(spark, path, sample.schema)[0]


def _restart_file(spark, sf) -> tuple[str, DataFrame]:
    """The county stage as CSV: empty texts and null tokens for nulls, and two bad lines."""
    stage = pipeline.events_with_county(transformed(spark, sf), edges(spark))
    path = scratch_path(spark, "restart")
    token = F.when(F.crc32("earthquake_id") % 2 == 0, "NA")
    ev.write_stage(stage.withColumn("county", F.coalesce("county", token)), path, fmt="csv")
    cells = ["abc" if c == "mag" else "x" if c == "state" else "" for c in stage.columns]
    bad = [(0, ",".join(stage.columns)), (1, "not,an,event"), (2, ",".join(cells))]
    local_table(spark, bad, [("i", "int"), ("value", "string")]).coalesce(1) \
        .sortWithinPartitions("i").select("value").write.mode("append").text(path)
    return path, stage


def q_stage_restart_csv(spark, sf):
    """A stage re-read from CSV with its types; bad lines do not get in."""
    path, stage = _restart_file(spark, sf)
    return ev.read_stage_csv(spark, path, stage.schema)[0]


def q_stage_rejects_csv(spark, sf):
    """What a stage file held that is no row of it, beside the rows that are."""
    path, stage = _restart_file(spark, sf)
    good, bad = ev.read_stage_csv(spark, path, stage.schema)
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).unionByName(
        good.agg(F.lit("accepted").alias("reason"), F.count(F.lit(1)).alias("n")))


def q_county_file_join(spark, sf):
    """Events joined to a county file (a hole, several parts, a collection)."""
    path = scratch_path(spark, "county_file")
    write_county_file(spark, path)
    layer = cty.read_geojson(spark, path)
    return spatial.point_in_polygon_pairs(raw(spark, sf), layer, salt_cols=["id"]).select("id", "county")


# --- projections / predicates ------------------------------------------------------

def q_dropna_any(spark, sf):
    return clean.drop_incomplete(raw(spark, sf))


def q_parse_place(spark, sf):
    return clean.parse_place(clean.drop_incomplete(raw(spark, sf))).select(
        "id", "place", "distance", "direction", "nearest", "state")


def _parsed(spark, sf):
    return clean.drop_incomplete(clean.parse_place(clean.drop_incomplete(raw(spark, sf))))


def q_expand_state(spark, sf):
    return clean.expand_state(_parsed(spark, sf)).select("id", "state")


def q_classify_country(spark, sf):
    return clean.classify_country(clean.expand_state(_parsed(spark, sf))) \
                .select("id", "state", "country", "continent")


def q_us_filter(spark, sf):
    return clean.us_only(clean.classify_country(clean.expand_state(_parsed(spark, sf)))) \
                .select("id", "state", "country", "continent")


def q_assign_region(spark, sf):
    return clean.us_regions_only(clean.assign_region(transformed(spark, sf))) \
                .select("earthquake_id", "state", "region")


def q_clean_distance(spark, sf):
    return clean.clean_distance(transformed(spark, sf)).select("earthquake_id", "offset_distance")


def q_cast_half_even(spark, sf):
    return clean.half_even_ints(clean.drop_incomplete(raw(spark, sf)), "magNst", "nst") \
                .select("id", F.col("magNst").alias("mag_nst"), "nst")


def q_clean_pipeline(spark, sf):
    return transformed(spark, sf)


# --- spatial ---------------------------------------------------------------------------

def q_county_join(spark, sf):
    return pipeline.events_with_county(transformed(spark, sf), edges(spark))


def q_county_multi_match(spark, sf):
    return pipeline.multi_match_report(
        pipeline.events_with_county(transformed(spark, sf), edges(spark)))


def q_point_in_polygon(spark, sf):
    pairs = spatial.point_in_polygon_pairs(raw(spark, sf), edges(spark), salt_cols=["id"])
    return pairs.select("id", "county")


def q_final_dataset(spark, sf):
    return final(spark, sf)


def q_staging_events(spark, sf):
    return staging(spark, sf)


# --- warehouse ---------------------------------------------------------------------------

def q_upsert_insert_only(spark, sf):
    """Two batches: events before the split, then every event (re-delivery)."""
    stg = staging(spark, sf)
    wh = Warehouse(spark)
    first = stg.where(F.col("time") < F.lit(BATCH_SPLIT).cast(stg.schema["time"].dataType))
    for batch in (first, stg):
        wh.load_batch(batch, star=False)
    return wh.table("location")


def _star_rows(wh: Warehouse) -> DataFrame:
    """The star by natural keys: fact rows with their time and place, and their 3NF metrics."""
    events = wh.table("earthquake").select("earthquake_id", "updated", "seismic_metrics_id")
    metrics = wh.table("seismic_metrics").select("seismic_metrics_id", "gap")
    places = wh.table("location_dim").select("location_id", "state", "county", "latitude", "longitude")
    return (wh.table("earthquake_fact")
            .join(places, "location_id")
            .join(wh.table("time_dim").select("time_id", "full_timestamp"), "time_id")
            .join(events.join(metrics, "seismic_metrics_id"), "earthquake_id")
            .select("earthquake_id", "full_timestamp", "updated", "state", "county", "latitude",
                    "longitude", "magnitude", "depth", "gap"))


def _revised(stg: DataFrame) -> DataFrame:
    """The same events as delivered again after a review."""
    later = F.expr("INTERVAL 40 DAYS")
    return stg.withColumns({"mag": F.col("mag") + 1, "gap": F.col("gap") + 1,
                            "updated": F.col("updated") + later, "time": F.col("time") + later})


def q_upsert_revised(spark, sf):
    """Events before the split, then every event in a revised version.

    What is stored keeps its first version in every layer, even where the
    revised time lies in another month; the rest comes in revised.
    """
    stg = staging(spark, sf)
    wh = Warehouse(spark)
    wh.load_batch(stg.where(F.col("time") < F.lit(BATCH_SPLIT).cast(stg.schema["time"].dataType)))
    wh.load_batch(_revised(stg))
    return _star_rows(wh)


def q_upsert_duplicates(spark, sf):
    """A2: one delivery that holds every event twice, the second time revised."""
    stg = staging(spark, sf)
    wh = Warehouse(spark).load_batch(_revised(stg).unionByName(stg))
    return _star_rows(wh)


def q_check_unique(spark, sf):
    wh = warehouse(spark, sf)
    checks = [("staging_events", S.STAGING_KEY)]
    checks += [(name, [id_col]) for name, (id_col, _) in S.KEYS.items()]
    checks += [(name, key) for name, (_, key) in S.KEYS.items()]
    checks += [("earthquake", ["earthquake_id"]), ("earthquake_fact", ["earthquake_id"])]
    parts = [validate.unique_violations(wh.table(t), k, t) for t, k in checks]
    return _union(parts)


def q_check_not_null(spark, sf):
    wh = warehouse(spark, sf)
    parts = []
    for t in ("location", "magnitude_detail", "seismic_metrics", "data_source", "earthquake",
              "time_dim", "location_dim", "magnitude_type_dim", "data_source_dim",
              "status_dim", "earthquake_fact"):
        parts.append(validate.null_counts(wh.table(t)).select(
            F.lit(t).alias("table_name"), "column_name", "nulls"))
    return _union(parts)


def q_quarantine_nulls(spark, sf):
    """V2 alternative: the raw events a not-null gate would quarantine."""
    _, bad = validate.quarantine_nulls(raw(spark, sf), S.RAW_COLUMNS)
    return bad


def q_check_range(spark, sf):
    return validate.range_violations(warehouse(spark, sf).table("time_dim"),
                                     S.TIME_DIM_RANGES, "time_dim")


def q_check_refs(spark, sf):
    wh = warehouse(spark, sf)
    parts = []
    for child, fks in S.FOREIGN_KEYS.items():
        for col, parent in fks:
            parts.append(validate.reference_violations(
                wh.table(child), col, wh.table(parent), S.KEYS[parent][0], child, parent))
    return _union(parts)


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- profile -------------------------------------------------------------------------------

def _counts(dim: str, k: int | None = None):
    def q(spark, sf):
        counts = profile.category_counts(final_stage(spark, sf), [dim])
        counts = counts.select(F.col("value").alias(dim), F.col("n").cast("long").alias("n"))
        return counts.orderBy(F.col("n").desc(), dim).limit(k) if k else counts
    return q


def q_category_counts(spark, sf):
    return profile.category_counts(final_stage(spark, sf)).withColumn("n", F.col("n").cast("long"))


def q_top_per_category(spark, sf):
    return profile.top_k(q_category_counts(spark, sf), 3)


def q_mag_summary(spark, sf):
    return _rounded(profile.magnitude_summary(final_stage(spark, sf)))


def q_depth_summary(spark, sf):
    return _rounded(profile.depth_summary(final_stage(spark, sf)))


def q_time_range(spark, sf):
    return profile.time_range(final_stage(spark, sf))


def q_yearly_counts(spark, sf):
    return profile.yearly_counts(final_stage(spark, sf)).withColumn("n", F.col("n").cast("long"))


def q_geo_range(spark, sf):
    return profile.geo_range(final_stage(spark, sf))


def q_profile(spark, sf):
    return _rounded(profile.profile(final_stage(spark, sf)))


def q_stage_audit(spark, sf):
    return pipeline.stage_counts(raw(spark, sf), edges(spark))


def q_stage_audit_observed(spark, sf):
    """A9 without extra passes: stage counts observed while the final dataset is written."""
    df, obs = pipeline.observed_final_dataset(raw(spark, sf), edges(spark))
    ev.write_stage(df, scratch_path(spark, "final_observed"))
    return local_table(spark, pipeline.observed_counts(obs),
                       [("stage", "string"), ("position", "int"), ("n_rows", "bigint")])


def q_sample_n(spark, sf):
    return profile.sample_rows(final_stage(spark, sf), SAMPLE_SIZE, seed=SAMPLE_SEED)


def q_sample_json(spark, sf):
    """T4, T5: the sample's head as JSON records, read back field by field."""
    rows = final_stage(spark, sf)
    sample = profile.sample_rows(rows, SAMPLE_SIZE, seed=SAMPLE_SEED)
    records = profile.to_json_records(profile.sample_head(sample, 6, seed=SAMPLE_SEED))
    return profile.from_json_records(records, rows)


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), 6).alias(f.name)
                       if f.dataType.simpleString() == "double" else F.col(f.name)
                       for f in df.schema.fields])


# --- OLAP ------------------------------------------------------------------------------------

def q_olap_top_states(spark, sf):
    wh = warehouse(spark, sf)
    return olap.top_states(wh.table("earthquake_fact"), wh.table("location_dim"))


def q_olap_monthly(spark, sf):
    wh = warehouse(spark, sf)
    return olap.monthly_trend(wh.table("earthquake_fact", with_month=True), wh.table("time_dim"))


def q_olap_regions(spark, sf):
    wh = warehouse(spark, sf)
    return olap.region_activity(wh.table("earthquake_fact", with_month=True), wh.table("location_dim"),
                                wh.table("time_dim"), min_year=OLAP_MIN_YEAR)


def q_rollup_geo(spark, sf):
    wh = warehouse(spark, sf)
    return olap.rollup_geography(wh.table("earthquake_fact"), wh.table("location_dim"))


def q_rollup_time(spark, sf):
    wh = warehouse(spark, sf)
    return olap.rollup_time(wh.table("earthquake_fact"), wh.table("time_dim"))


def q_drill_down(spark, sf):
    wh = warehouse(spark, sf)
    return olap.drill_down(wh.table("earthquake_fact"), wh.table("location_dim"),
                           {"region": "West"}, "state")


def q_drill_down_county(spark, sf):
    wh = warehouse(spark, sf)
    return olap.drill_down(wh.table("earthquake_fact"), wh.table("location_dim"),
                           {"region": "West", "state": "California"}, "county")


def q_drill_down_time(spark, sf):
    wh = warehouse(spark, sf)
    return olap.drill_down_time(wh.table("earthquake_fact", with_month=True), wh.table("time_dim"),
                                {"year": 1997, "month": 3}, "day")


def q_slice_dice(spark, sf):
    wh = warehouse(spark, sf)
    return olap.slice_dice(wh.table("earthquake_fact"), wh.table("location_dim"),
                           mag_range=(3.0, 6.0), depth_range=(None, 20.0),
                           regions=["West", "South"])


def q_cube_cross(spark, sf):
    wh = warehouse(spark, sf)
    return olap.cube_cross(wh.table("earthquake_fact"), wh.table("location_dim"),
                           wh.table("magnitude_type_dim"))


def q_pivot_cross(spark, sf):
    wh = warehouse(spark, sf)
    mt = wh.table("magnitude_type_dim")
    # The pivot columns come from the small magnitude-type dimension.
    types = [r["mag_type"] for r in
             mt.select("mag_type").orderBy("mag_type").limit(olap.PIVOT_COLUMNS + 1).collect()]
    return olap.pivot_cross(wh.table("earthquake_fact"), wh.table("location_dim"), mt, types)


def q_mag_histogram(spark, sf):
    return olap.magnitude_histogram(final_stage(spark, sf), HISTOGRAM_WIDTH)


def q_mag_depth_corr(spark, sf):
    return olap.magnitude_depth(final_stage(spark, sf))


def q_depth_bands(spark, sf):
    return olap.depth_band_means(final_stage(spark, sf))


def q_density_grid(spark, sf):
    return spatial.density_grid(final_stage(spark, sf), DENSITY_CELL_DEG) \
                  .withColumn("n_events", F.col("n_events").cast("long"))


def q_spatial_clusters(spark, sf):
    return clusters.density_clusters(final_stage(spark, sf), CLUSTER_CELL_DEG, CLUSTER_MIN_EVENTS)


def q_calendar(spark, sf):
    return olap.calendar_counts(final_stage(spark, sf))


def q_seasonal(spark, sf):
    return olap.seasonal_counts(final_stage(spark, sf))


def q_significant(spark, sf):
    return olap.significant_events(final_stage(spark, sf), SIGNIFICANT_MAGNITUDE)


def q_completeness(spark, sf):
    return validate.completeness(raw(spark, sf))


def q_monthly_change(spark, sf):
    wh = warehouse(spark, sf)
    return olap.monthly_change(wh.table("earthquake_fact", with_month=True), wh.table("location_dim"),
                               wh.table("time_dim"))


def q_quantiles(spark, sf):
    wh = warehouse(spark, sf)
    return olap.magnitude_quantiles(wh.table("earthquake_fact"), wh.table("location_dim"))


def q_source_quality(spark, sf):
    wh = warehouse(spark, sf)
    return olap.source_quality(wh.table("earthquake"), wh.table("data_source"),
                               wh.table("magnitude_detail"), wh.table("seismic_metrics"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "month_spine": q_month_spine,
    "month_audit": q_month_audit,
    "source_filter": q_source_filter,
    "union_months": q_union_months,
    "stage_roundtrip": q_stage_roundtrip,
    "stage_restart_csv": q_stage_restart_csv,
    "stage_rejects_csv": q_stage_rejects_csv,
    "dropna_any": q_dropna_any,
    "parse_place": q_parse_place,
    "expand_state": q_expand_state,
    "classify_country": q_classify_country,
    "us_filter": q_us_filter,
    "assign_region": q_assign_region,
    "clean_distance": q_clean_distance,
    "cast_half_even": q_cast_half_even,
    "clean_pipeline": q_clean_pipeline,
    "county_join": q_county_join,
    "county_multi_match": q_county_multi_match,
    "point_in_polygon": q_point_in_polygon,
    "county_file_join": q_county_file_join,
    "final_dataset": q_final_dataset,
    "staging_events": q_staging_events,
    "load_location": _t("location"),
    "load_magnitude_detail": _t("magnitude_detail"),
    "load_seismic_metrics": _t("seismic_metrics"),
    "load_data_source": _t("data_source"),
    "load_event": _t("earthquake"),
    "load_time_dim": _t("time_dim"),
    "load_location_dim": _t("location_dim"),
    "load_magnitude_type_dim": _t("magnitude_type_dim"),
    "load_data_source_dim": _t("data_source_dim"),
    "load_status_dim": _t("status_dim"),
    "load_fact": _t("earthquake_fact"),
    "upsert_insert_only": q_upsert_insert_only,
    "upsert_revised": q_upsert_revised,
    "upsert_duplicates": q_upsert_duplicates,
    "check_unique": q_check_unique,
    "check_not_null": q_check_not_null,
    "quarantine_nulls": q_quarantine_nulls,
    "check_range": q_check_range,
    "check_refs": q_check_refs,
    "category_counts": q_category_counts,
    "top_per_category": q_top_per_category,
    "region_counts": _counts("region"),
    "state_top10": _counts("state", 10),
    "county_top10": _counts("county", 10),
    "county_top5": _counts("county", 5),
    "mag_type_counts": _counts("magType"),
    "status_counts": _counts("status"),
    "mag_summary": q_mag_summary,
    "depth_summary": q_depth_summary,
    "time_range": q_time_range,
    "yearly_counts": q_yearly_counts,
    "geo_range": q_geo_range,
    "stage_audit": q_stage_audit,
    "stage_audit_observed": q_stage_audit_observed,
    "profile": q_profile,
    "olap_top_states": q_olap_top_states,
    "olap_monthly": q_olap_monthly,
    "olap_regions": q_olap_regions,
    "rollup_geo": q_rollup_geo,
    "rollup_time": q_rollup_time,
    "drill_down": q_drill_down,
    "drill_down_county": q_drill_down_county,
    "drill_down_time": q_drill_down_time,
    "slice_dice": q_slice_dice,
    "cube_cross": q_cube_cross,
    "pivot_cross": q_pivot_cross,
    "mag_histogram": q_mag_histogram,
    "mag_depth_corr": q_mag_depth_corr,
    "depth_bands": q_depth_bands,
    "density_grid": q_density_grid,
    "spatial_clusters": q_spatial_clusters,
    "calendar": q_calendar,
    "seasonal": q_seasonal,
    "significant": q_significant,
    "completeness": q_completeness,
    "monthly_change": q_monthly_change,
    "quantiles": q_quantiles,
    "source_quality": q_source_quality,
    "sample_n": q_sample_n,
    "sample_json": q_sample_json,
    "sample_csv": q_sample_csv,
}

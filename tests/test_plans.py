"""Plan shapes that the design relies on (checked on the executed plan)."""

import re

from tremor.plans import queries as Q


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_source_filter_pushed_to_scan(spark, sf_small):
    plan = _plan(Q.QUERIES["source_filter"](spark, sf_small))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert any("GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p
               for p in pushed)


def test_event_path_has_no_sort_merge_join(spark, sf_small):
    plan = _plan(Q.final(spark, sf_small))
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") >= 4
    # the place grammar and the polygon test are each evaluated once per row
    assert plan.count("regexp_extract(") <= 4 and plan.count("RLIKE") <= 1


def test_staging_dedup_limits_before_shuffle(spark, sf_small):
    plan = _plan(Q.staging(spark, sf_small))
    assert plan.count("WindowGroupLimit") == 2      # partial (map side) + final


def test_olap_scans_are_pruned(spark, sf_small):
    plan = _plan(Q.QUERIES["olap_top_states"](spark, sf_small))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<location_id:bigint>" in schemas
    assert "struct<location_id:bigint,state:string>" in schemas


def test_olap_aggregates_before_joining(spark, sf_small):
    df = Q.QUERIES["rollup_geo"](spark, sf_small)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    join_at = optimized.find("Join Inner")
    # a partial aggregate on location_id sits below the dimension join
    assert join_at > 0 and "Aggregate [location_id" in optimized[join_at:]


def test_spread_only_when_under_split(spark):
    from tremor.plans.pipeline import spread
    many = spark.range(1000).repartition(16)
    assert spread(many, 8) is many
    one = spark.range(1000).coalesce(1)
    assert spread(one, 8).rdd.getNumPartitions() == 8
    # default target: Catalyst's size estimate, capped at the parallelism
    tiny = spark.range(10).coalesce(1)
    assert spread(tiny).rdd.getNumPartitions() == 1


def test_no_raw_fact_row_meets_a_join(spark, sf_small):
    """Above every scan of the fact stands an aggregate before any join."""
    for name in ("olap_top_states", "olap_monthly", "olap_regions", "rollup_geo", "rollup_time",
                 "drill_down", "drill_down_time", "slice_dice", "cube_cross", "monthly_change"):
        tree = Q.QUERIES[name](spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
        path = []
        for line in tree.splitlines():
            depth = len(line) - len(line.lstrip(" :+-"))
            path = [(d, n) for d, n in path if d < depth] + [(depth, line.strip(" :+-"))]
            if path[-1][1].startswith("Relation [earthquake_id"):
                above = [n.split(" ")[0] for _, n in reversed(path[:-1])]
                assert next(n for n in above if n in ("Aggregate", "Join")) == "Aggregate", name


def test_years_and_months_prune_folders(spark, sf_small):
    for name in ("olap_regions", "drill_down_time"):
        plan = _plan(Q.QUERIES[name](spark, sf_small))
        assert re.search(r"PartitionFilters: \[[^\]]*event_year", plan), name


def test_building_the_cleaning_plan_runs_no_job(spark, sf_small):
    raw = Q.raw(spark, sf_small)           # reads parquet schemas
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    try:
        Q.pipeline.transformed_events(raw)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(tracker.getJobIdsForGroup("building")) == []


def test_stage_audit_scans_the_events_once(spark, sf_small):
    plan = _plan(Q.QUERIES["stage_audit"](spark, sf_small))
    assert plan.count("orders.parquet") == 1

"""The paths taken at scale give the same tables as the small-data paths."""

from tremor.plans import pipeline
from tremor.plans.warehouse import Warehouse
from tremor.sources.testdata import event_view, fixture_county_edges


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_salted_shuffle_spatial_join_equals_broadcast(spark, sf_mid):
    raw, edges = event_view(spark, sf_mid), fixture_county_edges(spark)
    a = pipeline.final_dataset(raw, edges, broadcast=True)
    b = pipeline.final_dataset(raw, edges, broadcast=False, salt=7)
    c = pipeline.final_dataset(raw, edges, broadcast=False, salt=1, cell_size=0.5)
    ra = _rows(a)
    assert ra == _rows(b) == _rows(c)
    assert len(ra) == 6659


def test_many_key_ranges_equal_few(spark, sf_small):
    stg = pipeline.staging_events(event_view(spark, sf_small), fixture_county_edges(spark)).checkpoint()
    small = Warehouse(spark).load_all(stg)
    saved = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = Warehouse(spark, parallel=1).load_all(stg)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", saved)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in ("location", "seismic_metrics", "time_dim", "location_dim", "earthquake",
                 "earthquake_fact"):
        assert _rows(small.table(name)) == _rows(big.table(name)), name


def test_salted_join_runs_as_shuffle_and_spreads_a_hot_cell(spark):
    from pyspark.sql import functions as F

    from tremor.operators import spatial
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled",
                                            "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = 4000
        # 80% of the points in one cell (a hot spot), the rest spread out
        pts = spark.range(n).select(
            F.col("id").cast("int").alias("i"),
            F.when(F.col("id") % 5 != 0, F.lit(-117.5) + (F.col("id") % 97) / 1000.0)
             .otherwise(F.lit(-119.9) + (F.col("id") % 89) / 10.0).alias("longitude"),
            F.when(F.col("id") % 5 != 0, F.lit(32.5) + (F.col("id") % 89) / 1000.0)
             .otherwise(F.lit(30.1) + (F.col("id") % 83) / 10.0).alias("latitude"))
        from tremor.sources.testdata import fixture_county_edges
        edges = fixture_county_edges(spark)
        salted = spatial.spatial_join(pts, edges, keep="all", broadcast=False, salt=8,
                                      salt_cols=["i"])
        plan = salted._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        per_task = [r["c"] for r in salted.groupBy(F.spark_partition_id().alias("p"))
                    .agg(F.count(F.lit(1)).alias("c")).collect()]
        assert max(per_task) < 0.5 * sum(per_task)        # the hot cell is split
        ref = spatial.spatial_join(pts, edges, keep="all", broadcast=True)
        assert sorted(tuple(r) for r in salted.collect()) == sorted(tuple(r) for r in ref.collect())
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)

"""The event pipeline: raw events -> cleaned -> county -> region -> staging.

One lazy plan.  The scan feeds one narrow chain (parsing, broadcast lookups,
the broadcast cell-index join), so with a small polygon layer the path from
scan to the final dataset shuffles nothing (an under-split source is first
spread round-robin, see ``spread``).  Region depends only on the state, so
the region filter runs *before* the spatial join: same rows as filtering
afterwards, fewer points to test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from tremor.operators import clean, spatial
from tremor.functions import fixed_values as fv
from tremor.schemas import FINAL_COLUMNS, STAGING_TYPES
from tremor.session import byte_setting
from tremor.sources.events import require_columns


# Source bytes per task for the CPU-heavy chain when a source must be spread.
SPREAD_BYTES_PER_TASK = 512 * 1024


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Guarantee enough tasks for the CPU-heavy chain (regex parse, polygon tests).

    A source that Spark splits widely by itself needs nothing.  A small one
    (one file with one row group) would run the whole chain in a handful of
    tasks, so its rows are spread round-robin first (Spark sorts before a
    round-robin exchange, so a retried task sends every row to the same
    place).  The target is the bytes of the source files over
    ``SPREAD_BYTES_PER_TASK``, capped at the cluster's parallelism.  All of
    this is read off the plan: no job runs.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution()
    physical = plan.executedPlan()
    if physical.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        physical = physical.initialPlan()
    known = physical.outputPartitioning().numPartitions()       # 0: a file scan
    if min_partitions is None:
        cap = spark.sparkContext.defaultParallelism
        leaves = plan.optimizedPlan().collectLeaves()
        size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
        min_partitions = max(1, min(cap, -(-size // SPREAD_BYTES_PER_TASK)))
        if not known:
            known = size // byte_setting(spark, "spark.sql.files.maxPartitionBytes", 128 << 20)
    return df if known >= min_partitions else df.repartition(min_partitions)


def transformed_events(raw: DataFrame, complete: bool = False) -> DataFrame:
    """Cleaning stage."""
    return clean.clean_and_transform(spread(raw), complete=complete)


def events_with_county(transformed: DataFrame, edges: DataFrame, **spatial_kw) -> DataFrame:
    """County stage (C1): left spatial join, multi-matches kept as rows."""
    spatial_kw.setdefault("salt_cols", ["earthquake_id"])
    return spatial.spatial_join(transformed, edges, keep="all", **spatial_kw).drop("polygon_id")


def finalize(with_county: DataFrame, strict: bool = True) -> DataFrame:
    """Finalisation stage (P1, P8, P6, P9, P10) over the county stage output.

    A row with a null in any column is dropped, whatever stage file it was
    read from.
    """
    require_columns(with_county, "state", "county", "offset_distance")
    df = clean.drop_incomplete(with_county)
    df = clean.assign_region(df)
    df = clean.drop_columns(df, "continent", "country", "polygon_id")
    df = clean.us_regions_only(df)
    df = clean.clean_distance(df, strict=strict)
    return df.select(*FINAL_COLUMNS)


def final_dataset(raw: DataFrame, edges: DataFrame, *, complete: bool = False,
                  strict: bool = True, keep: str = "all", **spatial_kw) -> DataFrame:
    """Raw events -> final US dataset (27 columns), one lazy plan.

    ``keep="all"`` keeps one row per matching county (a point on a shared
    border appears twice, as in a left spatial join); ``keep="smallest"``
    keeps one row per event with the smallest matching county.
    """
    df = transformed_events(raw, complete)
    df = clean.us_regions_only(clean.assign_region(df))
    spatial_kw.setdefault("salt_cols", ["earthquake_id"])
    df = spatial.spatial_join(df, edges, keep=keep, **spatial_kw)
    df = df.where(F.col("county").isNotNull())
    df = clean.drop_columns(df, "continent", "country", "polygon_id")
    df = clean.clean_distance(df, strict=strict)
    return df.select(*FINAL_COLUMNS)


# Which row of an event id staging keeps: earliest, then smallest county,
# then the rest of the row (both staging paths use this order).
STAGING_ORDER = ["time", "county"] + [c for c in FINAL_COLUMNS
                                      if c not in ("earthquake_id", "time", "county")]


def staging_events(raw: DataFrame, edges: DataFrame, **kw) -> DataFrame:
    """Typed staging table, one row per ``earthquake_id``.

    Border points resolve to their smallest county inside the spatial join
    (per row, no shuffle).  An id delivered more than once (overlapping
    monthly files) keeps its earliest row, ties broken by the full row; this
    is one shuffle on the id, with Spark's per-partition top-1 limit applied
    before the exchange.
    """
    final = final_dataset(raw, edges, keep="smallest", **kw)
    return to_staging_types(first_per_key(final, ["earthquake_id"], STAGING_ORDER))


def staging_from_final(final: DataFrame) -> DataFrame:
    """S9 from a final dataset (file): one row per event, earliest first, then
    the full row, so a border point keeps its smallest county."""
    return to_staging_types(first_per_key(final, ["earthquake_id"], STAGING_ORDER))


def to_staging_types(df: DataFrame) -> DataFrame:
    """S9 typed projection: the 27 staging columns cast to their declared types."""
    return df.select(*[F.col(c).cast(STAGING_TYPES[c]).alias(c) if c in STAGING_TYPES
                       else F.col(c) for c in FINAL_COLUMNS])


def first_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per key in ``order`` (deterministic: full-row tie-break)."""
    w = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def multi_match_report(with_county: DataFrame, key: str = "earthquake_id") -> DataFrame:
    """Events that matched more than one county: ``key, n_counties, counties``.

    (key, county) pairs are deduplicated first (map-side partial
    aggregation), so repeated copies of one event collapse before the
    shuffle and each collected group holds at most the polygons meeting at
    one point.
    """
    pairs = with_county.where(F.col("county").isNotNull()).select(key, "county").distinct()
    return (pairs.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_counties"),
                 F.array_join(F.array_sort(F.collect_list("county")), ",").alias("counties"))
            .where(F.col("n_counties") > 1))


def stage_counts(raw: DataFrame, edges, **spatial_kw) -> DataFrame:
    """A9 in one pass: ``stage, position, n_rows, n_columns`` of the pipeline's stages.

    No row is dropped on the way; each is tagged with the furthest stage it
    reaches, and one aggregate sums the tags cumulatively.  A row that matches
    several counties counts once per county from the county stage on.  Sums
    are part of the result, not side effects, so a retried task counts once.
    """
    n_raw = len(raw.columns)
    complete = F.lit(True)
    for c in raw.columns:
        complete = complete & F.col(c).isNotNull()
    df = clean.parse_place(spread(raw).withColumn("_complete", complete))
    parsed = F.col("_complete")
    for c in ("distance", "direction", "nearest", "state"):
        parsed = parsed & F.col(c).isNotNull()
    df = clean.classify_country(clean.expand_state(df.withColumn("_parsed", parsed)))
    american = (F.col("_parsed") & (F.col("continent") != fv.UNKNOWN)
                & (F.col("country") == fv.UNITED_STATES))
    df = clean.assign_region(df.withColumn("_american", american))
    # a point off the way needs no polygon test
    df = df.withColumns({c: F.when(F.col("_american"), F.col(c)) for c in ("longitude", "latitude")})
    spatial_kw.setdefault("salt_cols", ["id"])
    found = spatial.with_matches(df, edges, **spatial_kw)
    reached = (F.when(~F.col("_complete"), 0).when(~F.col("_parsed"), 1)
               .when(~F.col("_american"), 2).otherwise(3))
    # one generator row: the exact test runs once, whatever reads its result
    tags = found.select(F.inline(F.array(F.struct(
        reached.alias("reached"), F.size("_m").alias("counties"),
        (F.col("region") != fv.NON_US).alias("regional")))))
    american = F.col("reached") == 3
    sums = {"raw": (F.lit(1), n_raw), "complete": (F.col("reached") >= 1, n_raw),
            "place_parsed": (F.col("reached") >= 2, n_raw + 4),
            "united_states": (american, n_raw + 5),
            "with_county": (F.when(american, F.greatest(F.col("counties"), F.lit(1))), n_raw + 6),
            "final": (F.when(american & F.col("regional"), F.col("counties")), len(FINAL_COLUMNS))}
    wide = tags.agg(*[F.coalesce(F.sum(x.cast("long")), F.lit(0)).alias(name)
                      for name, (x, _) in sums.items()])
    rows = [F.struct(F.lit(name).alias("stage"), F.lit(i).alias("position"),
                     F.col(name).alias("n_rows"), F.lit(width).alias("n_columns"))
            for i, (name, (_, width)) in enumerate(sums.items())]
    return wide.select(F.inline(F.array(*rows)))


OBSERVED_STAGES = ["raw", "complete", "place_parsed", "united_states", "us_regions",
                   "with_county", "final"]


def observed_final_dataset(raw: DataFrame, edges: DataFrame, **spatial_kw
                           ) -> tuple[DataFrame, dict[str, Observation]]:
    """``final_dataset`` with a row count observed at every stage.

    The counts are collected by the action that runs the returned plan
    (``Observation``), so the audit costs no extra pass over the data.
    Stage order is the optimised one: the region filter comes before the
    spatial join.
    """
    obs = {name: Observation(name) for name in OBSERVED_STAGES}

    def tap(df: DataFrame, name: str) -> DataFrame:
        return df.observe(obs[name], F.count(F.lit(1)).alias("rows"))

    df = tap(spread(raw), "raw")
    df = tap(clean.drop_incomplete(df), "complete")
    df = clean.parse_place(df)
    df = tap(clean.drop_incomplete(df, ["distance", "direction", "nearest", "state"]),
             "place_parsed")
    df = clean.classify_country(clean.expand_state(df))
    df = tap(clean.us_only(clean.drop_columns(clean.rename_columns(df), "place")),
             "united_states")
    df = tap(clean.us_regions_only(clean.assign_region(df)), "us_regions")
    spatial_kw.setdefault("salt_cols", ["earthquake_id"])
    df = spatial.spatial_join(df, edges, keep="all", **spatial_kw)
    df = tap(df.where(F.col("county").isNotNull()), "with_county")
    df = clean.clean_distance(clean.drop_columns(df, "continent", "country", "polygon_id"))
    return tap(df.select(*FINAL_COLUMNS), "final"), obs


def observed_counts(obs: dict[str, Observation]) -> list[tuple[str, int, int]]:
    """``(stage, position, rows)`` after the observed plan has run."""
    return [(name, i, int(obs[name].get["rows"])) for i, name in enumerate(OBSERVED_STAGES)]

"""OLAP over the star schema and the final dataset.

Star queries aggregate the fact on its foreign key *before* joining the
dimension, then re-aggregate at the dimension's level.  Partial aggregation
runs map-side, so a key holding a third of all events (one swarm location,
one busy second) is collapsed to one row per task before any shuffle, and
the join sees one row per key instead of one per event.  Averages are
carried as (sum, count) through that step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.operators.quantiles import exact_quantiles

MEASURE = "magnitude"
# Event month columns of a fact read with its folders.
MONTH = ["event_year", "event_month"]
PIVOT_COLUMNS = 1000
QUARTILES = {"q_min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "q_max": 1.0}


def _partials(df: DataFrame, keys: list[str], measure: str = MEASURE,
              threshold: float = 5.0) -> DataFrame:
    m = F.col(measure)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(m).alias("_s"),
                                 F.max(m).alias("_mx"),
                                 F.count_if(m > threshold).alias("_big"))


def _finals(round_to: int = 6) -> list[Column]:
    """Additive measures for roll-ups: counts and magnitude sums add up
    across levels (averages do not), so every level is exact."""
    return [F.sum("_n").cast("long").alias("earthquake_count"),
            F.round(F.sum("_s"), round_to).alias("sum_magnitude"),
            F.max("_mx").alias("max_magnitude"),
            F.sum("_big").cast("long").alias("major_earthquakes")]


def _per_month(fact: DataFrame, time_dim: DataFrame, keys: list[str]) -> DataFrame:
    """Partial measures per ``keys, year, month``.

    A fact that knows its event month (``Warehouse.table(with_month=True)``:
    the folder it is stored in) needs no time join at all.  Otherwise it is
    aggregated per time key first.
    """
    if set(MONTH) <= set(fact.columns):
        named = fact.withColumnsRenamed(dict(zip(MONTH, ("year", "month"))))
        return _partials(named, [*keys, "year", "month"])
    return (_partials(fact, [*keys, "time_id"])
            .join(time_dim.select("time_id", "year", "month"), "time_id"))


def top_states(fact: DataFrame, location_dim: DataFrame, k: int = 10) -> DataFrame:
    """A11 + C6: events per state, top ``k`` (ties by state name)."""
    per_loc = fact.groupBy("location_id").agg(F.count(F.lit(1)).alias("_n"))
    per_state = (per_loc.join(location_dim.select("location_id", "state"), "location_id")
                 .groupBy("state").agg(F.sum("_n").cast("long").alias("earthquake_count")))
    return per_state.orderBy(F.col("earthquake_count").desc(), "state").limit(k)


def monthly_trend(fact: DataFrame, time_dim: DataFrame) -> DataFrame:
    """Events and mean magnitude per (year, month), in calendar order."""
    per_m = (_per_month(fact, time_dim, [])
             .groupBy("year", "month")
             .agg(F.sum("_n").cast("long").alias("earthquake_count"),
                  F.round(F.sum("_s") / F.sum("_n"), 6).alias("avg_magnitude")))
    return per_m.orderBy("year", "month")


def region_activity(fact: DataFrame, location_dim: DataFrame, time_dim: DataFrame,
                    min_year: int = 2020, threshold: float = 5.0) -> DataFrame:
    """A13 + P14: per region count, mean, max and count above ``threshold``
    for events from ``min_year`` on.

    With the event month at hand the year prunes folders; without it the fact
    is aggregated per (location, time) before it meets the time dimension.
    """
    if set(MONTH) <= set(fact.columns):
        per_loc = _partials(fact.where(F.col(MONTH[0]) >= min_year), ["location_id"],
                            threshold=threshold)
    else:
        times = time_dim.where(F.col("year") >= min_year).select("time_id")
        per_loc = _partials(fact, ["location_id", "time_id"], threshold=threshold) \
            .join(times, "time_id", "left_semi")
    return (per_loc.join(location_dim.select("location_id", "region"), "location_id")
            .groupBy("region")
            .agg(F.sum("_n").cast("long").alias("total_earthquakes"),
                 F.round(F.sum("_s") / F.sum("_n"), 6).alias("avg_magnitude"),
                 F.max("_mx").alias("max_magnitude"),
                 F.sum("_big").cast("long").alias("major_earthquakes"))
            .orderBy(F.col("total_earthquakes").desc(), "region"))


def rollup_geography(fact: DataFrame, location_dim: DataFrame) -> DataFrame:
    """O1: county -> state -> region -> national totals (ROLLUP)."""
    per_loc = _partials(fact, ["location_id"])
    joined = per_loc.join(location_dim.select("location_id", "region", "state", "county"),
                          "location_id")
    return (joined.rollup("region", "state", "county")
            .agg(F.grouping_id().alias("grouping_level"), *_finals()))


def rollup_time(fact: DataFrame, time_dim: DataFrame) -> DataFrame:
    """O2: day -> month -> quarter -> year -> all totals (ROLLUP)."""
    per_t = _partials(fact, ["time_id"])
    joined = per_t.join(time_dim.select("time_id", "year", "quarter", "month", "day"), "time_id")
    return (joined.rollup("year", "quarter", "month", "day")
            .agg(F.grouping_id().alias("grouping_level"), *_finals()))


def drill_down(fact: DataFrame, location_dim: DataFrame, path: dict[str, str],
               level: str) -> DataFrame:
    """O3 (geography): fix the parent levels in ``path`` and break down by ``level``."""
    return drill_down_dim(fact, location_dim, "location_id", path, level)


def drill_down_dim(fact: DataFrame, dim: DataFrame, key: str, path: dict, level: str,
                   derived: dict | None = None) -> DataFrame:
    """O3 on any dimension: aggregate the facts per key, join the dimension
    rows that lie on ``path``, then aggregate per ``level``.  ``derived`` adds
    computed levels to the dimension first (for example the hour of
    ``full_timestamp``, which the time dimension does not store)."""
    dims = dim.withColumns(derived or {})
    for col, value in path.items():
        dims = dims.where(F.col(col) == value)
    return (_partials(fact, [key]).join(dims.select(key, *path.keys(), level), key)
            .groupBy(*path.keys(), level).agg(*_finals()))


def drill_down_time(fact: DataFrame, time_dim: DataFrame, path: dict[str, int],
                    level: str) -> DataFrame:
    """O3 (time): year -> quarter -> month -> day -> hour.

    A year or month on the path prunes the folders of a fact that knows its
    event month.
    """
    for column, name in zip(MONTH, ("year", "month")):
        if column in fact.columns and name in path:
            fact = fact.where(F.col(column) == path[name])
    hour = {"hour": F.hour("full_timestamp")} if level == "hour" or "hour" in path else None
    return drill_down_dim(fact, time_dim, "time_id", path, level, hour)


def slice_dice(fact: DataFrame, location_dim: DataFrame, *, mag_range=None,
               depth_range=None, regions: list[str] | None = None,
               by: tuple[str, ...] = ("region", "state")) -> DataFrame:
    """Filter by magnitude range, depth range and regions, then group.

    Ranges are half-open ``[lo, hi)``; ``None`` leaves a side open.
    """
    f = fact
    for col, rng in (("magnitude", mag_range), ("depth", depth_range)):
        if rng is None:
            continue
        lo, hi = rng
        if lo is not None:
            f = f.where(F.col(col) >= lo)
        if hi is not None:
            f = f.where(F.col(col) < hi)
    dims = location_dim
    if regions:
        dims = dims.where(F.col("region").isin(list(regions)))
    per_loc = _partials(f, ["location_id"])
    return (per_loc.join(dims.select("location_id", *by), "location_id")
            .groupBy(*by).agg(*_finals()))


def cube_cross(fact: DataFrame, location_dim: DataFrame,
               magnitude_type_dim: DataFrame) -> DataFrame:
    """Every combination of region and magnitude type, with subtotals (CUBE)."""
    per = _partials(fact, ["location_id", "magnitude_type_id"])
    joined = (per.join(location_dim.select("location_id", "region"), "location_id")
              .join(magnitude_type_dim, "magnitude_type_id"))
    return joined.cube("region", "mag_type").agg(F.grouping_id().alias("grouping_level"),
                                                 *_finals())


def pivot_cross(fact: DataFrame, location_dim: DataFrame, magnitude_type_dim: DataFrame,
                mag_types: list[str]) -> DataFrame:
    """Regions as rows, magnitude types as columns (event counts).

    ``mag_types`` is the explicit column list (taken from the small
    magnitude-type dimension), so the pivot needs no extra distinct job; more
    than ``PIVOT_COLUMNS`` of them raise an error.
    """
    if len(mag_types) > PIVOT_COLUMNS:
        raise ValueError(f"more than {PIVOT_COLUMNS} pivot columns")
    per = _partials(fact, ["location_id", "magnitude_type_id"])
    joined = (per.join(location_dim.select("location_id", "region"), "location_id")
              .join(magnitude_type_dim, "magnitude_type_id"))
    wide = joined.groupBy("region").pivot("mag_type", mag_types).agg(F.sum("_n"))
    return wide.select("region", *[F.coalesce(F.col(t), F.lit(0)).cast("long").alias(t)
                                   for t in mag_types])


def magnitude_histogram(df: DataFrame, width: float = 0.5, col: str = "mag") -> DataFrame:
    """Events per magnitude bin ``[bin_start, bin_start + width)``."""
    b = F.floor(F.col(col) / F.lit(float(width)))
    return (df.where(F.col(col).isNotNull())
              .groupBy(b.alias("bin"))
              .agg(F.count(F.lit(1)).alias("n"))
              .select((F.col("bin") * F.lit(float(width))).alias("bin_start"),
                      F.col("n").cast("long").alias("n")))


def magnitude_depth(df: DataFrame, mag: str = "mag", depth: str = "depth") -> DataFrame:
    """Correlation and covariance of magnitude and depth (one aggregate)."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("n"),
                  F.round(F.corr(mag, depth), 6).alias("corr_mag_depth"),
                  F.round(F.covar_samp(mag, depth), 6).alias("covar_mag_depth"))


def depth_band_means(df: DataFrame, band_km: float = 10.0) -> DataFrame:
    """Magnitude per depth band as ``n`` and ``sum_magnitude``.

    The band mean is ``sum_magnitude / n``; the pair is exact and additive
    (bands can be merged), while a rounded floating mean can land on either
    side of a decimal tie depending on summation order.
    """
    b = F.floor(F.col("depth") / F.lit(float(band_km)))
    return (df.where(F.col("depth").isNotNull() & F.col("mag").isNotNull())
              .groupBy((b * F.lit(float(band_km))).alias("depth_band"))
              .agg(F.count(F.lit(1)).cast("long").alias("n"),
                   F.round(F.sum("mag"), 6).alias("sum_magnitude")))


def calendar_counts(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Events per calendar day, days without events included (0).

    The day spine is generated from the data's first and last day; its size
    is the number of days spanned, not the number of events.
    """
    day = F.to_date(F.col(time_col))
    counts = df.where(F.col(time_col).isNotNull()).groupBy(day.alias("day")) \
               .agg(F.count(F.lit(1)).alias("n"))
    spine = counts.agg(F.min("day").alias("lo"), F.max("day").alias("hi")) \
                  .select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return (spine.join(counts, "day", "left")
            .select("day", F.year("day").alias("year"), F.month("day").alias("month"),
                    F.dayofweek("day").alias("day_of_week"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n_events")))


def seasonal_counts(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Events per month of the year (all years together)."""
    return (df.where(F.col(time_col).isNotNull())
              .groupBy(F.month(time_col).alias("month"))
              .agg(F.count(F.lit(1)).cast("long").alias("n_events")))


def significant_events(df: DataFrame, threshold: float = 6.0, col: str = "mag",
                       key: str = "earthquake_id") -> DataFrame:
    """Events above ``threshold``, strongest first."""
    return df.where(F.col(col) > threshold).orderBy(F.col(col).desc(), F.col(key))


def monthly_change(fact: DataFrame, location_dim: DataFrame, time_dim: DataFrame) -> DataFrame:
    """Month-over-month change of event counts per region.

    The window runs over the aggregated (region, year, month) table, whose
    size is regions x months, never over events.
    """
    monthly = (_per_month(fact, time_dim, ["location_id"])
               .join(location_dim.select("location_id", "region"), "location_id")
               .groupBy("region", "year", "month")
               .agg(F.sum("_n").cast("long").alias("earthquake_count")))
    w = Window.partitionBy("region").orderBy("year", "month")
    prev = F.lag("earthquake_count").over(w)
    return monthly.select("region", "year", "month", "earthquake_count",
                          prev.alias("previous_count"),
                          (F.col("earthquake_count") - prev).alias("change"),
                          F.round((F.col("earthquake_count") - prev) / prev, 6)
                          .alias("change_ratio"))


def magnitude_quantiles(fact: DataFrame, location_dim: DataFrame) -> DataFrame:
    """Box-plot quantiles of magnitude per region, exact at any size.

    The fact is counted per (location, magnitude) before the dimension join.
    """
    per_loc = fact.groupBy("location_id", "magnitude").agg(F.count(F.lit(1)).alias("_n"))
    joined = per_loc.join(location_dim.select("location_id", "region"), "location_id")
    return exact_quantiles(joined, ["region"], "magnitude", QUARTILES, weight="_n")


def source_quality(earthquake: DataFrame, data_source: DataFrame,
                   magnitude_detail: DataFrame, seismic_metrics: DataFrame) -> DataFrame:
    """Coverage, mean errors and freshness per network and magnitude source.

    The 3NF fact is pre-aggregated on its three foreign keys first.
    """
    per = earthquake.groupBy("data_source_id", "magnitude_detail_id", "seismic_metrics_id") \
        .agg(F.count(F.lit(1)).alias("_n"), F.max("updated").alias("_upd"))
    j = (per.join(data_source, "data_source_id")
         .join(magnitude_detail, "magnitude_detail_id")
         .join(seismic_metrics, "seismic_metrics_id"))
    n = F.col("_n")
    return (j.groupBy("net", "mag_source")
            .agg(F.sum(n).cast("long").alias("n_events"),
                 F.round(F.sum(F.col("mag_error") * n) / F.sum(n), 6).alias("avg_mag_error"),
                 F.round(F.sum(F.col("rms") * n) / F.sum(n), 6).alias("avg_rms"),
                 F.round(F.sum(F.col("gap") * n) / F.sum(n), 6).alias("avg_gap"),
                 F.max("_upd").alias("last_updated")))

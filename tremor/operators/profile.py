"""Dataset profile (A3-A10) and sampling.

The whole numeric profile is one aggregate (one pass over the data).  All
category counts come from one long-form aggregate ``(dimension, value, n)``,
so five "value counts" cost one shuffle of partial counts, and top-k lists
are ranked with a window over that small aggregated table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.sources.events import require_columns

PROFILE_CATEGORIES = ["region", "state", "county", "magType", "status"]


def category_counts(df: DataFrame, dims: list[str] | None = None) -> DataFrame:
    """A3: ``dimension, value, n`` for each present column; nulls excluded."""
    dims = [d for d in (dims or PROFILE_CATEGORIES) if d in df.columns]
    if not dims:
        raise ValueError("none of the category columns is present")
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"),
                                         F.col(d).cast("string").alias("value"))
                                for d in dims]))
    return (df.select(pairs.alias("p"))
              .where(F.col("p.value").isNotNull())
              .groupBy(F.col("p.dimension").alias("dimension"), F.col("p.value").alias("value"))
              .agg(F.count(F.lit(1)).alias("n")))


def top_k(counts: DataFrame, k: int, partition: str | None = "dimension",
          count_col: str = "n", key_col: str = "value") -> DataFrame:
    """Top ``k`` rows by count (ties by key), per ``partition`` if given.

    Operates on an already aggregated table (one row per group).
    """
    order = [F.col(count_col).desc(), F.col(key_col).asc()]
    if partition is None:
        return counts.orderBy(*order).limit(k)
    w = Window.partitionBy(partition).orderBy(*order)
    return (counts.withColumn("rank", F.row_number().over(w))
                  .where(F.col("rank") <= k))


def value_counts(df: DataFrame, col: str, k: int | None = None) -> DataFrame:
    """A3 + T1 for one column: ``col, n`` sorted by count descending."""
    counts = (df.where(F.col(col).isNotNull()).groupBy(col)
                .agg(F.count(F.lit(1)).alias("n")))
    ordered = counts.orderBy(F.col("n").desc(), F.col(col).asc())
    return ordered.limit(k) if k else ordered


def _magnitude_aggs() -> list[Column]:
    m = F.col("mag")
    return [F.min(m).alias("mag_min"), F.max(m).alias("mag_max"),
            F.avg(m).alias("mag_mean"), F.stddev_samp(m).alias("mag_std"),
            F.count_if(m > 5.0).alias("mag_over_5"), F.count_if(m > 6.0).alias("mag_over_6")]


def _depth_aggs() -> list[Column]:
    d = F.col("depth")
    return [F.min(d).alias("depth_min"), F.max(d).alias("depth_max"),
            F.avg(d).alias("depth_mean"), F.count_if(d < 10.0).alias("depth_under_10")]


def _time_aggs() -> list[Column]:
    return [F.date_format(F.min("time"), "yyyy-MM-dd").alias("time_start"),
            F.date_format(F.max("time"), "yyyy-MM-dd").alias("time_end")]


def _geo_aggs() -> list[Column]:
    return [F.min("latitude").alias("lat_min"), F.max("latitude").alias("lat_max"),
            F.min("longitude").alias("lon_min"), F.max("longitude").alias("lon_max")]


def magnitude_summary(df: DataFrame) -> DataFrame:
    """A4: min, max, mean, sample std, counts above 5 and 6."""
    return df.agg(*_magnitude_aggs())


def depth_summary(df: DataFrame) -> DataFrame:
    """A5: min, max, mean, count shallower than 10 km."""
    return df.agg(*_depth_aggs())


def time_range(df: DataFrame) -> DataFrame:
    """First and last event day as ``yyyy-MM-dd``."""
    return df.agg(*_time_aggs())


def yearly_counts(df: DataFrame) -> DataFrame:
    """Events per calendar year, ascending."""
    return (df.where(F.col("time").isNotNull())
              .groupBy(F.year("time").alias("year")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy("year"))


def geo_range(df: DataFrame) -> DataFrame:
    """Latitude and longitude ranges."""
    return df.agg(*_geo_aggs())


def profile(df: DataFrame) -> DataFrame:
    """A10: every scalar statistic in one aggregate (one pass).

    Sections run only when their columns exist, like the reference's guards.
    """
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_rows"),
                          F.lit(len(df.columns)).alias("n_columns")]
    if "mag" in df.columns:
        aggs += _magnitude_aggs()
    if "depth" in df.columns:
        aggs += _depth_aggs()
    if "time" in df.columns:
        aggs += _time_aggs()
    if "latitude" in df.columns and "longitude" in df.columns:
        aggs += _geo_aggs()
    return df.agg(*aggs)


def sample_rows(df: DataFrame, n: int = 80, key: str = "earthquake_id", seed: int = 0) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same on any partitioning and any engine.

    Rows are ranked by ``md5(key || ':' || seed)`` (ties by the full row) and
    the first ``n`` are kept: a per-partition top-n then a merge of at most
    ``n`` rows per partition, never a global sort.
    """
    require_columns(df, key)
    order = [F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), F.col(key)] + \
            [F.col(c).asc_nulls_first() for c in df.columns if c != key]
    return df.orderBy(*order).limit(n)


def sample_head(sample: DataFrame, n: int = 6, key: str = "earthquake_id", seed: int = 0) -> DataFrame:
    """T4: the first ``n`` rows of a sample in sample order."""
    return sample_rows(sample, n, key, seed)


def to_json_records(df: DataFrame, ts_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """T5: one JSON text per row, timestamps formatted as text first."""
    ts_types = ("timestamp", "timestamp_ntz")
    cols = [F.date_format(F.col(f.name), ts_format).alias(f.name)
            if f.dataType.simpleString() in ts_types else F.col(f.name)
            for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*cols)).alias("record"))


def from_json_records(records: DataFrame, like: DataFrame) -> DataFrame:
    """Fields of ``to_json_records`` texts, typed as in ``like``; timestamps stay text."""
    ts_types = ("timestamp", "timestamp_ntz")
    schema = T.StructType([T.StructField(f.name, T.StringType()
                                         if f.dataType.simpleString() in ts_types else f.dataType)
                           for f in like.schema.fields])
    return records.select(F.from_json("record", schema).alias("r")).select("r.*")

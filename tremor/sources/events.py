"""Event sources and sinks.

Raw events arrive as monthly CSV files.  They are read with a fixed schema
(never inferred): every column is read as text, a list of null tokens is
mapped to null, and then each column is cast to its ``RAW_SCHEMA`` type, so
``"NaN"``, ``"NA"``, ``"null"``... count as missing exactly like the
pandas-based reader of the reference.

Months are folders ``year=YYYY/month=M``; selecting months is a partition
filter on one scan, not a loop of reads.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.schemas import RAW_COLUMNS, RAW_SCHEMA

# FIXED VALUES — strings that pandas' CSV reader treats as missing by default.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

TEXT_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in RAW_COLUMNS])


def _typed(col: Column, dtype: T.DataType, tokens: list[str]) -> Column:
    value = F.when(col.isin(tokens), F.lit(None)).otherwise(col)
    if isinstance(dtype, T.StringType):
        return value
    return value.cast(dtype)


def read_events_csv(spark: SparkSession, paths: str | list[str],
                    null_tokens: list[str] | None = None) -> DataFrame:
    """Scan raw event CSV files (a file, a folder or a list of them).

    The header must name the raw columns (checked by Spark, any order is
    accepted by name); partition folders ``year=/month=`` are kept as columns
    so month filters prune files.
    """
    raw = (spark.read.schema(TEXT_SCHEMA)
           .option("header", True)
           .option("enforceSchema", False)
           .option("mode", "FAILFAST")
           .csv(paths))
    return type_raw(raw, null_tokens)


def type_raw(text: DataFrame, null_tokens: list[str] | None = None) -> DataFrame:
    """Raw events read as text -> ``RAW_SCHEMA`` types (null tokens -> null).

    Extra columns (partition folders such as ``year``/``month``) are kept.
    """
    tokens = NULL_TOKENS if null_tokens is None else null_tokens
    typed = [_typed(F.col(f.name), f.dataType, tokens).alias(f.name) for f in RAW_SCHEMA]
    extra = [c for c in text.columns if c not in RAW_COLUMNS]
    return text.select(*typed, *extra)


def month_spine(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One row per month: ``year, month, month_start, month_end, next_month``.

    ``month_end`` is the last calendar day; ``next_month`` is the exclusive
    upper bound used for filtering (months are half-open intervals).
    """
    start = F.make_date(F.lit(first_year), F.lit(1), F.lit(1))
    stop = F.make_date(F.lit(last_year), F.lit(12), F.lit(1))
    return _spine(spark.range(1).select(start.alias("lo"), stop.alias("hi")))


def month_spine_of(events: DataFrame, time_col: str = "time") -> DataFrame:
    """S2 over the months an event table actually spans (one small aggregate)."""
    return _spine(events.agg(F.min(time_col).alias("lo"), F.max(time_col).alias("hi")))


def _spine(bounds: DataFrame) -> DataFrame:
    months = bounds.select(F.explode(F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"),
                                                F.expr("INTERVAL 1 MONTH")))
                           .alias("month_start"))
    return months.select(
        F.year("month_start").alias("year"),
        F.month("month_start").alias("month"),
        "month_start",
        F.last_day("month_start").alias("month_end"),
        F.add_months("month_start", 1).alias("next_month"),
    )


def month_audit(events: DataFrame, time_col: str = "time") -> DataFrame:
    """A9 per month: events per month of the spanned range, missing months as 0.

    Months between two that have events are generated from the counted months
    themselves, so a month whose file failed to arrive shows up as a zero row
    and the events are scanned once.  The window runs over one row per month.
    """
    counts = (events.where(F.col(time_col).isNotNull())
              .groupBy(F.trunc(time_col, "month").alias("m"))
              .agg(F.count(F.lit(1)).alias("n")))
    last = F.coalesce(F.add_months(F.lead("m").over(Window.orderBy("m")), -1), F.col("m"))
    every = F.explode(F.sequence("m", "last", F.expr("INTERVAL 1 MONTH")))
    return (counts.withColumn("last", last).select("m", "n", every.alias("d"))
            .select(F.year("d").alias("year"), F.month("d").alias("month"),
                    F.when(F.col("d") == F.col("m"), F.col("n")).otherwise(0).cast("long")
                    .alias("n_events")))


def source_filter(events: DataFrame, start: str | None, end_exclusive: str | None,
                  min_magnitude: float = 0.0, time_col: str = "time",
                  sort: bool = True) -> DataFrame:
    """S3: ``start <= time < end_exclusive`` and ``mag >= min_magnitude``; a bound may be absent.

    Comparisons are on the column's own type, so a parquet source receives
    the predicate as a pushed filter.  ``sort`` orders by time like the
    event service does.
    """
    t = F.col(time_col)
    kind = events.schema[time_col].dataType
    out = events.where(F.col("mag") >= F.lit(float(min_magnitude)))
    if start is not None:
        out = out.where(t >= F.lit(start).cast(kind))
    if end_exclusive is not None:
        out = out.where(t < F.lit(end_exclusive).cast(kind))
    return out.orderBy(time_col, "id") if sort else out


def union_frames(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by column name; frames without rows are harmless."""
    frames = list(frames)
    if not frames:
        raise ValueError("no event frames to combine")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_months(spark: SparkSession, root: str, first_year: int | None = None,
                last_year: int | None = None) -> DataFrame:
    """All months under ``root`` in one scan, pruned to a year range.

    Missing months are simply absent folders (the reference skips failed
    downloads the same way).
    """
    df = read_events_csv(spark, root)
    if first_year is not None:
        df = df.where(F.col("year") >= first_year)
    if last_year is not None:
        df = df.where(F.col("year") <= last_year)
    return df


def write_months(events: DataFrame, root: str, fmt: str = "csv",
                 mode: str = "errorifexists") -> None:
    """Write events partitioned by ``year=/month=`` folders.

    Rows are rebalanced by month first, so a month gets a few files of a
    sensible size instead of one from every task; adaptive execution splits a
    month that holds a third of the data over many tasks.
    """
    out = (events.withColumn("year", F.year("time")).withColumn("month", F.month("time"))
           .hint("rebalance", "year", "month"))
    writer = out.write.mode(mode).partitionBy("year", "month")
    if fmt == "csv":
        writer.option("header", True).csv(root)
    else:
        writer.parquet(root)


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write a stage result (transformed, county, final)."""
    if fmt == "csv":
        df.write.mode(mode).option("header", True).csv(path)
    else:
        df.write.mode(mode).parquet(path)


def read_stage(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Read a stage result back."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.parquet(path)


def read_stage_csv(spark: SparkSession, path: str, schema: T.StructType,
                   null_tokens: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """A stage result stored as CSV -> ``(typed rows, rejects)``.

    Every column is read as text; null tokens become null and the rest is cast
    to ``schema``.  A line that is malformed, or holds a text that its
    column's type cannot take, goes to the rejects (``reason, record``) and
    neither fails the job nor turns into nulls.  ``reason`` is ``malformed``
    or the first such column.
    """
    tokens = NULL_TOKENS if null_tokens is None else null_tokens
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                        + [T.StructField("_corrupt", T.StringType())])
    # all columns are parsed whatever is selected: else a short line can pass unnoticed
    lines = (spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", "_corrupt").option("columnPruning", False)
             .csv(path))
    given = {f.name: F.when(~F.col(f.name).isin(tokens), F.col(f.name)) for f in schema.fields}
    typed = {f.name: given[f.name].try_cast(f.dataType) for f in schema.fields}
    reason = F.when(F.col("_corrupt").isNotNull(), "malformed")
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            reason = reason.when(given[f.name].isNotNull() & typed[f.name].isNull(), f.name)
    good = lines.where(reason.isNull()).select(*[c.alias(n) for n, c in typed.items()])
    record = F.coalesce("_corrupt", F.to_csv(F.struct(*[f.name for f in schema.fields])))
    bad = lines.where(reason.isNotNull()).select(reason.alias("reason"), record.alias("record"))
    return good, bad


def write_sample(sample: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a sample (at most a few dozen rows) as one CSV file."""
    sample.coalesce(1).write.mode(mode).option("header", True).csv(path)


def require_columns(df: DataFrame, *cols: str) -> None:
    """Fail at plan time when required columns are missing (no job runs)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"missing required columns: {missing}")


def has_columns(df: DataFrame, *cols: str) -> bool:
    """S11 guard form: whether all columns exist."""
    return all(c in df.columns for c in cols)

"""Data-quality checks (V1-V4), completeness (O11) and the row audit.

Each check returns a small report DataFrame and is re-runnable at any time
(unlike constraints added once with ALTER TABLE).  Every check is one
aggregate or one anti-join: no per-column passes over the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """V1 detail: keys that occur more than once, with their count."""
    return (df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1))


def unique_violations(df: DataFrame, key_cols: list[str], table: str) -> DataFrame:
    """V1: one row ``table, key_columns, duplicate_keys, duplicate_rows``."""
    d = duplicate_keys(df, key_cols)
    return d.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                 F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows")) \
            .select(F.lit(table).alias("table_name"),
                    F.lit(",".join(key_cols)).alias("key_columns"),
                    F.col("duplicate_keys").cast("long").alias("duplicate_keys"),
                    F.col("duplicate_rows").cast("long").alias("duplicate_rows"))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """V2: nulls per column, one aggregate, long form ``column_name, nulls``."""
    cols = cols or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, nulls)") \
               .withColumn("nulls", F.col("nulls").cast("long"))


def require_not_null(df: DataFrame, cols: list[str]) -> None:
    """V2 gate: raise when any of ``cols`` holds a null (one aggregate job)."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    bad = {c: row[c] for c in cols if row[c]}
    if bad:
        raise ValueError(f"null values in NOT NULL columns: {bad}")


def quarantine_nulls(df: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """V2 alternative to failing: ``(complete rows, rows with a null in cols)``."""
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(c).isNotNull()
    return df.where(complete), df.where(~complete)


def range_violations(df: DataFrame, ranges: dict[str, tuple[int, int]], table: str) -> DataFrame:
    """V3: rows outside ``[lo, hi]`` per checked column, one aggregate."""
    wide = df.agg(*[F.count_if(~F.col(c).between(lo, hi)).alias(c)
                    for c, (lo, hi) in ranges.items()])
    pairs = ", ".join(f"'{c}', `{c}`" for c in ranges)
    return wide.selectExpr(f"stack({len(ranges)}, {pairs}) as (column_name, violations)") \
               .select(F.lit(table).alias("table_name"), "column_name",
                       F.col("violations").cast("long").alias("violations"))


def orphan_rows(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """V4 detail: child rows whose foreign key has no parent row."""
    return child.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def reference_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str,
                         child_name: str, parent_name: str) -> DataFrame:
    """V4: one row ``child_table, column_name, parent_table, orphans``."""
    return orphan_rows(child, fk, parent, pk).agg(F.count(F.lit(1)).alias("orphans")) \
        .select(F.lit(child_name).alias("child_table"), F.lit(fk).alias("column_name"),
                F.lit(parent_name).alias("parent_table"),
                F.col("orphans").cast("long").alias("orphans"))


def completeness(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Share of non-null values per column (one aggregate, long form)."""
    cols = cols or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count(F.col(c)).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = wide.selectExpr("_rows", f"stack({len(cols)}, {pairs}) as (column_name, non_null)")
    return long.select("column_name",
                       F.col("non_null").cast("long").alias("non_null"),
                       F.col("_rows").cast("long").alias("total_rows"),
                       F.round(F.col("non_null").cast("double") / F.col("_rows"), 6)
                       .alias("completeness"))


def stage_audit(stages: dict[str, DataFrame]) -> DataFrame:
    """``stage, position, n_rows, n_columns`` for named stage results.

    Each stage is counted by its own aggregate; the audit is a union of
    one-row results, so it is a single job with one task set per stage.
    """
    rows = [df.agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(name).alias("stage"), F.lit(i).alias("position"),
                      F.col("n_rows").cast("long").alias("n_rows"),
                      F.lit(len(df.columns)).alias("n_columns"))
            for i, (name, df) in enumerate(stages.items())]
    return reduce(DataFrame.unionByName, rows)

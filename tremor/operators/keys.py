"""Surrogate keys (W1): dense integers in natural-key order, at any scale.

A global ``row_number() OVER (ORDER BY key)`` would pull the whole table
into one task.  Instead, and for every size alike:

1. range-partition the (distinct) natural keys and sort inside partitions,
   so partition *i* holds keys smaller than partition *i+1*; adaptive
   execution picks the number of partitions from the measured bytes;
2. write that result once to the shared folder with each row's
   ``monotonically_increasing_id`` (partition index in the upper bits,
   position in the lower 33): the layout is now a fact on storage and cannot
   change under a recompute (range sampling is not repeatable);
3. count rows per partition (one row per partition) and turn the counts into
   offsets, which travel with the plan as one constant array;
4. key = start + offset(partition) + position + 1.

The keys follow the natural-key order, so they do not depend on the input
partitioning, and repeated runs and different cluster sizes agree.  The
number of keys, and with it the highest one, comes out of step 3: nobody has
to scan the table for its maximum afterwards.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.session import UNMARKED, scratch_path

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def write_ordered(df: DataFrame, order: list[str], num_partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, written once, with ``_mid`` and ``_pid``."""
    spark = df.sparkSession
    cols = [F.col(c).asc() for c in order]
    placed = df.repartitionByRange(num_partitions, *cols) if num_partitions \
        else df.repartitionByRange(*cols)
    path = scratch_path(spark, "ranks")
    placed.sortWithinPartitions(*cols).withColumn("_mid", F.monotonically_increasing_id()) \
        .write.options(**UNMARKED).parquet(path)
    return spark.read.parquet(path).withColumn("_pid", F.shiftright("_mid", _POS_BITS))


def number_keys(df: DataFrame, key_cols: list[str], id_col: str, start: int = 0,
                num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """``df`` with ``id_col`` = start + rank of the natural key (dense, 1-based), and the highest.

    ``df`` must already be distinct on ``key_cols``.
    """
    tagged = write_ordered(df, key_cols, num_partitions)
    counts = dict(tuple(r) for r in tagged.groupBy("_pid").agg(F.count(F.lit(1))).collect())
    sums = list(accumulate((counts.get(p, 0) for p in range(max(counts, default=-1) + 1)), initial=0))
    # One constant per partition: bounded by the partition count, not by the data.  A
    # broadcast join of so small a table would be one more job with buffers on the driver.
    before = F.split(F.lit(" ".join(map(str, sums))), " ").cast("array<bigint>")
    key = (F.lit(int(start)) + F.get(before, F.col("_pid").cast("int"))
           + F.col("_mid").bitwiseAND(F.lit(_POS_MASK)) + 1)
    return tagged.select(key.cast("long").alias(id_col), *df.columns), int(start) + sums[-1]


def assign_surrogate_keys(df: DataFrame, key_cols: list[str], id_col: str, start: int = 0,
                          num_partitions: int | None = None) -> DataFrame:
    """``number_keys`` without the highest key."""
    return number_keys(df, key_cols, id_col, start, num_partitions)[0]


def max_key(df: DataFrame | None, id_col: str) -> int:
    """Largest existing key (0 for an empty or missing table)."""
    if df is None:
        return 0
    value = df.agg(F.max(id_col).alias("m")).first()["m"]
    return int(value or 0)

"""Exact quantiles per group by distributed selection.

Equal values are counted together first (map-side), so a group costs one row
per distinct value.  The counted values are range-partitioned by (group,
value): a group with a third of all values spreads over many partitions.
Each partition's sum per group becomes an offset, the running count inside a
partition finishes the rank, and the row whose ranks hold the wanted one is
the quantile.  No sketch, no accuracy, no group in one task.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremor.operators.keys import write_ordered


def exact_quantiles(df: DataFrame, group: list[str], value: str, probs: dict[str, float],
                    weight: str | None = None) -> DataFrame:
    """``group..., n`` and one column per entry of ``probs`` (name -> probability).

    The quantile is discrete: the least value whose cumulative count reaches
    ``probability * n``, and the minimum for 0.  Nulls do not count; ``weight``
    is a column of repeat counts.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counted = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(n.cast("long").alias("_n"))
    placed = write_ordered(counted, [*group, value])
    per = placed.groupBy("_pid", *group).agg(F.sum("_n").alias("_sum"))
    whole = Window.partitionBy(*group)
    offsets = per.select(
        F.col("_pid").alias("_opid"), *[F.col(g).alias(f"_o{i}") for i, g in enumerate(group)],
        F.sum("_sum").over(whole).alias("_total"),
        (F.sum("_sum").over(whole.orderBy("_pid")) - F.col("_sum")).alias("_before"))
    same = F.col("_pid") == F.col("_opid")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_o{i}"))
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy("_pid", *group).orderBy(value))
    ranked = placed.join(offsets, same).withColumn("_upto", upto)

    def pick(p: float):
        rank = F.greatest(F.ceil(F.col("_total") * F.lit(Decimal(str(p)))).cast("long"), F.lit(1))
        here = (F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank)
        return F.max(F.when(here, F.col(value)))
    return ranked.groupBy(*group).agg(F.max("_total").alias("n"),
                                      *[pick(p).alias(name) for name, p in probs.items()])

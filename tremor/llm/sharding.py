"""Operator 8: sharding by proportional stratified interleaving.

Within each source, rows are shuffled by a seeded hash and ranked; a row's
fractional rank is its place between 0 and 1.  All rows are then sorted by
fractional rank and cut into ranges whose sizes differ by one at most, so
every shard holds every source in its share of the mixture.

Both ranks are numbered over range partitions (partition offset plus place),
so a source with a third of all rows is spread over many tasks; the text is
read once, for its size and checksum, and never moved.  All steps are
DataFrame operations.

Results: a null text has size 1 and checksum 0; null sources form one
stratum; rows are ordered within a source by md5 of seed and id, then by
id, checksum and size, so repeated rows take adjacent slots; an empty table gives
no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import cut, positions

SHARDS = 8
SEED = 17


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, key: str = "doc_id",
          text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``key``, ``size``, ``text_crc32``, ``source``, ``shard`` and ``slot`` of every row."""
    mix = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    rows = cut(docs.select(
        F.col(key), (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(text_col, "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
        F.col(source_col).alias("source"), mix.alias("_mix")))
    tie = [F.col("_mix"), F.col(key).asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    ranked = positions(rows, [F.col("source").asc_nulls_first(), *tie], within="source")
    placed = ranked.select(
        key, "size", "text_crc32", "source",
        ((2 * F.col("_pos") + 1) / (2 * F.col("_total"))).alias("_fraction"))
    ordered = positions(placed, [F.col("_fraction"), F.col("source").asc_nulls_first()])
    # Shard s begins at the smallest place p with p * shards >= s * total.
    return (ordered.withColumn("shard", _exact(F.col("_pos") * shards, F.col("_total")))
            .withColumn("slot", F.col("_pos") - _exact(
                F.col("shard") * F.col("_total") + (shards - 1), F.lit(shards)))
            .select(key, "size", "text_crc32", "source", F.col("shard").cast("int").alias("shard"),
                    F.col("slot").cast("long").alias("slot")))


def _exact(a, b):
    """Integer quotient of two longs."""
    return F.floor((a - F.pmod(a, b)) / b).cast("long")

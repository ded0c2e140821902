"""Small helpers shared by the operators: tables, lineage cuts, ranks, Arrow mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

import tremor.llm
from tremor.session import ensure_checkpoint_dir, shuffle_partitions

# Row functions travel to the executors by value: they need not have this package.
cloudpickle.register_pickle_by_value(tremor.llm)

#: Rows of a few numbers that one task is given, where their number is known.
ROWS_A_TASK = 50_000
#: Rows of whole texts that travel to Python at a time, where the session has Spark's default.
TEXTS_A_BATCH = 1_000
_POS_BITS = 33
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows are written once to the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return estimated(df.checkpoint(eager=True))


def estimated(made: DataFrame) -> DataFrame:
    """The checkpoint ``made`` with an estimated size of 64 bits at most.

    A checkpoint goes by the estimate of the plan that made it, and a join's is the product
    of its sides'.  Where rows are joined with what was made of them, round after round, the
    estimate's digits double with each join until they fill the driver's heap.  One beyond
    64 bits gives way to Spark's own for an unknown size, which is as far above every limit.
    """
    plan = made._jdf.queryExecution().analyzed()
    if plan.stats().sizeInBytes() < 1 << 63:
        return made
    spark, jvm = made.sparkSession, made.sparkSession.sparkContext._jvm
    unknown = jvm.scala.Option.empty()
    plan = jvm.org.apache.spark.sql.execution.LogicalRDD(
        plan.output(), plan.rdd(), plan.outputPartitioning(), plan.outputOrdering(),
        plan.isStreaming(), plan.stream(), spark._jsparkSession, unknown, unknown)
    return DataFrame(jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan), spark)


def tasks(n: int) -> int:
    """Tasks for ``n`` short rows."""
    return 1 + n // ROWS_A_TASK


def counted(df: DataFrame, rows_a_task: int | None = None) -> tuple[DataFrame, int]:
    """``cut`` of ``df``, and its number of rows, which the same job counts.

    A table of a few rows then lies in a few partitions, so that the shuffles
    that read it don't write files for every task of the one that made it.
    """
    seen = Observation()
    made = cut(df.observe(seen, F.count(F.lit(1)).alias("n")))
    n = seen.get["n"]
    return made.coalesce(1 + n // (rows_a_task or ROWS_A_TASK)), n


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(c: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(c, _UPPER, _UPPER.lower())


def fenced(df: DataFrame, **made: Column) -> DataFrame:
    """Add columns that are computed once per row, whatever reads them.

    Catalyst writes a computed column into every expression and filter that
    uses it; it cannot do so with what a generator (here of one row) puts out.
    """
    packed = F.struct(*[c.alias(n) for n, c in made.items()])
    return df.select(*[c for c in df.columns if c not in made], F.inline(F.array(packed)))


def in_batches(df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterable[pa.RecordBatch]],
               schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for whole texts.

    Spark's default of 10,000 rows is some 30 MB of documents, held by the executor and by
    each of its workers; a session that has the default gets ``TEXTS_A_BATCH`` instead.
    """
    conf, rows = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(rows) == "10000":
        conf.set(rows, str(TEXTS_A_BATCH))
    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, start: Callable[[], Callable[..., tuple]], schema: T.StructType,
             chunk: int = 256) -> DataFrame:
    """``df``'s rows through a per-task function, in Arrow batches of ``chunk`` rows.

    ``start()`` runs once per task and returns the row function; that gets
    the row's values in column order and returns a tuple in schema order.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        f = start()
        for batch in batches:
            for lo in range(0, batch.num_rows, chunk):
                part = batch.slice(lo, chunk)
                rows = [f(*r) for r in zip(*(c.to_pylist() for c in part.columns))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(col, type=t.type) for col, t in zip(zip(*rows), arrow)],
                    schema=arrow)

    return in_batches(df, run, schema)


def positions(df: DataFrame, order: list[Column], within: str | None = None,
              partitions: int | None = None) -> DataFrame:
    """Add ``_pos`` (0-based rank by ``order``) and ``_total`` without a one-task sort.

    Rows are range-partitioned and sorted by ``order``, fixed by a checkpoint,
    and numbered by partition offset plus place in the partition.  With
    ``within``, a column that leads ``order``, both count inside its value.
    Offsets hold one row per partition and value of ``within`` that it holds.
    The order must be total but for rows that are equal in every column.
    """
    n = partitions or shuffle_partitions(df.sparkSession)
    placed = cut(df.repartitionByRange(n, *order).sortWithinPartitions(*order))
    tagged = (placed.withColumn("_mid", F.monotonically_increasing_id())
              .withColumn("_pid", F.shiftright("_mid", _POS_BITS)))
    keys = ["_pid"] + ([within] if within else [])
    parts = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    group = Window.partitionBy(within) if within else Window.partitionBy()
    offsets = parts.select(
        *keys, F.sum("_n").over(group).alias("_total"),
        (F.sum("_n").over(group.orderBy("_pid")) - F.col("_n") - F.col("_first")).alias("_off"))
    if within:
        offsets = offsets.withColumnsRenamed({"_pid": "_opid", within: "_owithin"})
        on = (F.col("_pid") == F.col("_opid")) & F.col(within).eqNullSafe(F.col("_owithin"))
        joined = tagged.join(offsets, on).drop("_opid", "_owithin")
    else:
        joined = tagged.join(offsets, "_pid")
    return (joined.withColumn("_pos", F.col("_mid") + F.col("_off"))
            .drop("_mid", "_pid", "_off"))

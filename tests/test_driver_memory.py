"""What a warehouse load holds on the driver at once."""

import os
import threading

from pyspark.sql import functions as F

from tremor.operators.keys import number_keys
from tremor.plans import queries as Q
from tremor.plans import warehouse as W
from tremor.plans.warehouse import Warehouse
from tremor.session import list_names, local_path


def _most_at_once(monkeypatch, wh, loads):
    running, most, lock = [], [], threading.Lock()
    started = threading.Barrier(wh.parallel)

    def load(self, name):
        with lock:
            running.append(name)
            most.append(len(running))
        started.wait(10)
        with lock:
            running.remove(name)
    monkeypatch.setattr(Warehouse, "_load_dimension", load)
    wh._load_dimensions([(f"dim{i}",) for i in range(loads)])
    return len(most), max(most)


def test_dimensions_load_one_by_one_by_default(monkeypatch):
    assert _most_at_once(monkeypatch, Warehouse(None, root="/unused"), 4) == (4, 1)


def test_dimensions_overlap_where_asked_for(monkeypatch):
    assert _most_at_once(monkeypatch, Warehouse(None, root="/unused", parallel=2), 4) == (4, 2)


def test_key_numbering_broadcasts_nothing(spark):
    rows = spark.range(300).select((F.col("id") * 7 % 300).alias("k"), F.lit("x").alias("v"))
    keyed, highest = number_keys(rows, ["k"], "key", start=5, num_partitions=9)
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan
    assert highest == 305
    assert sorted((r["k"], r["key"]) for r in keyed.collect()) == [(k, k + 6) for k in range(300)]


def test_key_numbering_of_nothing(spark):
    keyed, highest = number_keys(spark.range(0), ["id"], "key", start=5)
    assert (keyed.count(), highest) == (0, 5)


def _events(spark, sf_small):
    """Forty staged events, one more without an id and one without a time."""
    stg = Q.staging(spark, sf_small).orderBy("earthquake_id").limit(40)
    odd = stg.limit(1)
    no_id = odd.withColumn("earthquake_id", F.lit(None).cast("string"))
    no_time = odd.withColumns({"earthquake_id": F.lit("evx"),
                               "time": F.lit(None).cast(stg.schema["time"].dataType)})
    return stg.unionByName(no_id).unionByName(no_time).checkpoint()


def test_first_batch_takes_the_rows_a_lookup_would_find(spark, sf_small):
    stg = _events(spark, sf_small)
    wh = Warehouse(spark)
    wh.load_staging(stg)
    taken = wh.first_staged()
    looked_up = wh.staged(stg, wh.stored_months(stg)).select(*taken.columns)
    assert looked_up.count() == 40
    assert taken.exceptAll(looked_up).isEmpty()
    assert looked_up.exceptAll(taken).isEmpty()


def test_only_later_batches_look_up_their_events(spark, sf_small, monkeypatch):
    looked, released = [], []
    months = Warehouse.stored_months
    monkeypatch.setattr(Warehouse, "stored_months",
                        lambda self, rows: looked.append(1) or months(self, rows))
    monkeypatch.setattr(W, "release", released.append)
    stg = _events(spark, sf_small).where("earthquake_id IS NOT NULL AND time IS NOT NULL")
    wh = Warehouse(spark).load_batch(stg.limit(30))
    assert (looked, released) == ([], [spark] * 5)
    wh.load_batch(stg)
    assert looked == [1]
    assert wh.table("earthquake_fact").count() == 40
    one = Warehouse(spark).load_batch(stg)
    keys = ["earthquake_id", "magnitude", "depth"]
    assert wh.table("earthquake_fact").select(*keys).exceptAll(
        one.table("earthquake_fact").select(*keys)).isEmpty()


def _marked(spark, folder):
    """Marker files under a local folder, and its part files."""
    names = [n for _, _, files in os.walk(local_path(folder)) for n in files]
    return [n for n in names if "_SUCCESS" in n], [n for n in names if n.startswith("part-")]


def test_load_starts_no_process_for_marker_files(spark, sf_small):
    ranks = f"{spark.sparkContext.getCheckpointDir()}/tremor/ranks"
    before = set(list_names(spark, ranks))
    stg = _events(spark, sf_small).where("earthquake_id IS NOT NULL AND time IS NOT NULL")
    wh = Warehouse(spark).load_batch(stg)
    numbered = set(list_names(spark, ranks)) - before
    assert len(numbered) == 9
    for folder in [wh.root, *[f"{ranks}/{n}" for n in numbered]]:
        marks, parts = _marked(spark, folder)
        assert parts and not marks
    assert wh.table("earthquake_fact").count() == 40


def _joins(df):
    return str(df._jdf.queryExecution().optimizedPlan()).count("Join ")


def test_later_batch_measures_ids_without_joins_and_reads_its_events_once(
        spark, sf_small, monkeypatch):
    stg = _events(spark, sf_small).where("earthquake_id IS NOT NULL AND time IS NOT NULL")
    wh = Warehouse(spark).load_batch(stg.limit(30))
    measured, read = [], []
    restrict, star = W.restrict_to_batch, W.star_fact_rows

    def spied(table, batch, keys, *args):
        measured.append((keys, _joins(batch)))
        return restrict(table, batch, keys, *args)

    def built(eq, *dims):
        read.append(str(eq._jdf.queryExecution().optimizedPlan()).count("Relation "))
        return star(eq, *dims)
    monkeypatch.setattr(W, "restrict_to_batch", spied)
    monkeypatch.setattr(W, "star_fact_rows", built)
    batches = f"{spark.sparkContext.getCheckpointDir()}/tremor/batch"
    before = list_names(spark, batches)
    wh.load_batch(stg)
    by_id = [n for keys, n in measured if keys == ["earthquake_id"]]
    assert len(by_id) == 3 and by_id[-1] == 0 and max(by_id) <= 1
    assert read == [1 + 2]                      # the batch, and the stored ids with what restricts them
    assert list_names(spark, batches) == before
    monkeypatch.undo()
    one = Warehouse(spark).load_batch(stg)
    for name, cols in (("earthquake", ["earthquake_id", "time", "magnitude", "status"]),
                       ("earthquake_fact", ["earthquake_id", "magnitude", "depth"])):
        got, want = wh.table(name).select(*cols), one.table(name).select(*cols)
        assert got.count() == want.count() == 40
        assert got.exceptAll(want).isEmpty()

"""Warehouse invariants: idempotent insert-only loads, clean checks, 1:1 joins."""

import shutil

import pytest
from pyspark.sql import functions as F

from tremor import schemas as S
from tremor.operators import olap, validate
from tremor.plans import pipeline
from tremor.plans.warehouse import Warehouse
from tremor.sources.testdata import event_view, fixture_county_edges

TABLES = ["staging_events", "location", "magnitude_detail", "seismic_metrics", "data_source",
          "earthquake", "time_dim", "location_dim", "magnitude_type_dim", "data_source_dim",
          "status_dim", "earthquake_fact"]


@pytest.fixture(scope="module")
def built(spark, sf_small):
    stg = pipeline.staging_events(event_view(spark, sf_small), fixture_county_edges(spark))
    wh = Warehouse(spark).load_all(stg)
    return wh, stg


def test_counts_and_one_to_one(built):
    wh, stg = built
    n = stg.count()
    assert n == stg.select("earthquake_id").distinct().count()
    assert wh.table("earthquake").count() == n
    assert wh.table("earthquake_fact").count() == n


def test_rerun_adds_nothing(built):
    wh, stg = built
    before = {t: wh.table(t).count() for t in TABLES}
    wh.load_staging(stg)
    wh.load_reconciled()
    wh.load_star()
    assert {t: wh.table(t).count() for t in TABLES} == before


def test_checks_are_clean(built):
    wh, _ = built
    for name, (id_col, key) in S.KEYS.items():
        t = wh.table(name)
        assert validate.duplicate_keys(t, [id_col]).count() == 0
        assert validate.duplicate_keys(t, key).count() == 0
        assert all(r["nulls"] == 0 for r in validate.null_counts(t).collect())
    for child, fks in S.FOREIGN_KEYS.items():
        for col, parent in fks:
            assert validate.orphan_rows(wh.table(child), col, wh.table(parent),
                                        S.KEYS[parent][0]).count() == 0
    assert all(r["violations"] == 0 for r in
               validate.range_violations(wh.table("time_dim"), S.TIME_DIM_RANGES, "t").collect())


def test_keys_dense(built):
    wh, _ = built
    for name, (id_col, _) in S.KEYS.items():
        ids = sorted(r[0] for r in wh.table(name).select(id_col).collect())
        assert ids == list(range(1, len(ids) + 1)), name


def test_star_matches_staging(built):
    wh, stg = built
    star = {r["state"]: r["earthquake_count"] for r in
            olap.top_states(wh.table("earthquake_fact"), wh.table("location_dim"), 100).collect()}
    direct = {r["state"]: r["count"] for r in stg.groupBy("state").count().collect()}
    assert star == direct


def test_rollup_totals(built):
    wh, _ = built
    r = olap.rollup_geography(wh.table("earthquake_fact"), wh.table("location_dim"))
    total = r.where(F.col("grouping_level") == 7).first()["earthquake_count"]
    assert total == wh.table("earthquake_fact").count()
    leaves = r.where(F.col("grouping_level") == 0).agg(F.sum("earthquake_count")).first()[0]
    assert leaves == total


def test_two_batches_equal_one_on_natural_keys(spark, built):
    _, stg = built
    wh2 = Warehouse(spark)
    for batch in (stg.where(F.year("time") < 1998), stg):
        wh2.load_batch(batch)
    one = Warehouse(spark).load_all(stg)
    for name in ("location", "earthquake_fact"):
        cols = [c for c in one.table(name).columns if not c.endswith("_id") or c == "earthquake_id"]
        a = sorted(tuple(r) for r in one.table(name).select(*cols).collect())
        b = sorted(tuple(r) for r in wh2.table(name).select(*cols).collect())
        assert a == b


def test_not_null_gate(spark, built):
    _, stg = built
    bad = stg.limit(3).withColumn("county", F.lit(None).cast("string"))
    with pytest.raises(ValueError):
        Warehouse(spark).load_reconciled(bad)


def test_empty_batch_loads_cleanly(spark, built):
    wh, stg = built
    before = {t: wh.table(t).count() for t in TABLES}
    wh.load_batch(stg.where(F.lit(False)))
    assert {t: wh.table(t).count() for t in TABLES} == before
    fresh = Warehouse(spark).load_batch(stg.where(F.lit(False)))
    assert fresh.table("earthquake_fact").count() == 0


def test_drill_down_to_hour(built):
    wh, _ = built
    fact, tdim = wh.table("earthquake_fact"), wh.table("time_dim")
    months = olap.drill_down_time(fact, tdim, {"year": 1997}, "month").collect()
    assert sum(r["earthquake_count"] for r in months) == \
        fact.join(tdim.where("year = 1997"), "time_id").count()
    m = months[0]["month"]
    hours = olap.drill_down_time(fact, tdim, {"year": 1997, "month": m}, "hour").collect()
    assert [r["hour"] for r in hours] == [0]
    assert hours[0]["earthquake_count"] == [r for r in months if r["month"] == m][0][
        "earthquake_count"]


def test_both_staging_paths_agree(spark, sf_small):
    from tremor.plans import pipeline as P
    raw, edges = event_view(spark, sf_small), fixture_county_edges(spark)
    one_plan = P.staging_events(raw, edges)
    from_file = P.staging_from_final(P.final_dataset(raw, edges))
    assert sorted(tuple(r) for r in one_plan.collect()) == \
        sorted(tuple(r) for r in from_file.collect())


def test_complete_states_option(spark, sf_small):
    from tremor.plans import pipeline as P
    raw, edges = event_view(spark, sf_small), fixture_county_edges(spark)
    default = {r["state"] for r in P.final_dataset(raw, edges).select("state").distinct().collect()}
    full = {r["state"] for r in P.final_dataset(raw, edges, complete=True)
            .select("state").distinct().collect()}
    assert not {"Ohio", "Vermont"} & default
    assert {"Ohio", "Vermont"} <= full and default < full
    # "AL" expands to Alabama only with the completed abbreviation table
    al = P.final_dataset(raw.where("place LIKE '%, AL'"), edges, complete=True)
    assert {r["state"] for r in al.select("state").distinct().collect()} <= {"Alabama"}


def test_revised_redelivery_leaves_no_unreferenced_rows(spark, sf_small, tmp_path):
    """First write wins in every layer; a repeated id resolves alike on any partitioning."""
    from pyspark.sql import functions as F

    from tremor.plans import queries as Q
    stg = Q.staging(spark, sf_small).limit(120).checkpoint()
    revised = stg.withColumns({"gap": F.col("gap") + 1, "mag": F.col("mag") + 1,
                               "time": F.col("time") + F.expr("interval 1 day")})
    tables = ("staging_events", "earthquake", "location", "seismic_metrics", "earthquake_fact")
    seen = []
    for parts in (1, 7):
        wh = Warehouse(spark, str(tmp_path / f"wh{parts}"))
        wh.load_batch(stg.union(revised).repartition(parts))
        first = {t: wh.table(t).count() for t in tables}
        wh.load_batch(revised)
        assert {t: wh.table(t).count() for t in tables} == first
        seen.append(sorted(map(str, wh.table("staging_events").collect())))
    assert seen[0] == seen[1]


def _contents(wh):
    return {t: sorted(map(str, wh.table(t).collect())) for t in TABLES}


class Stopped(Exception):
    pass


@pytest.fixture(scope="module")
def two_batches(spark, built, tmp_path_factory):
    """A few events, the folder after the first of two batches, the tables after both."""
    _, stg = built
    few = stg.orderBy("earthquake_id").limit(80).checkpoint()
    early = few.where(F.year("time") < 1997)
    root = tmp_path_factory.mktemp("wh")
    Warehouse(spark, str(root / "early")).load_batch(early)
    shutil.copytree(root / "early", root / "clean")
    return few, root, _contents(Warehouse(spark, str(root / "clean")).load_batch(few))


@pytest.mark.parametrize("stop", ["after_staging", "half_dimension", "before_star"])
def test_batch_that_dies_leaves_nothing_and_runs_again(spark, two_batches, tmp_path, monkeypatch, stop):
    """A rerun equals one clean load, keys included; readers never see the dead batch."""
    stg, source, clean = two_batches
    root = str(tmp_path / "dying")
    shutil.copytree(source / "early", root)
    before = _contents(Warehouse.open(spark, root))

    def die(*a, **k):
        raise Stopped
    with monkeypatch.context() as m:
        real = Warehouse.append
        if stop == "after_staging":
            m.setattr(Warehouse, "load_reconciled", die)
        elif stop == "before_star":
            m.setattr(Warehouse, "load_star", die)
        else:
            def half(self, name, rows, highest=None):
                if name == "seismic_metrics":   # some files of the folder are there, then the end
                    real(self, name, rows.limit(5), highest)
                    raise Stopped
                return real(self, name, rows, highest)
            m.setattr(Warehouse, "append", half)
        with pytest.raises(Stopped):
            Warehouse.open(spark, root).load_batch(stg)
    assert _contents(Warehouse.open(spark, root)) == before
    again = Warehouse.open(spark, root).load_batch(stg)
    assert _contents(again) == _contents(Warehouse.open(spark, root)) == clean


def test_second_writer_fails_to_publish(spark, built, tmp_path):
    _, stg = built
    one, two = (Warehouse(spark, str(tmp_path / "wh")) for _ in range(2))
    with pytest.raises(Exception, match="publish|exist"):
        with two.batch():
            two.append("status_dim", stg.select("status", "type").distinct())
            one.load_staging(stg.limit(20))
    assert Warehouse.open(spark, one.root).has("staging_events")
    assert not Warehouse.open(spark, one.root).has("status_dim")


def test_a_batch_reads_only_the_months_of_its_ids(built):
    wh, stg = built
    few = stg.where("year(time) = 1997 AND month(time) = 3").checkpoint()
    months = wh.stored_months(few)
    assert months == [(1997, 3)]
    for df in (wh.staged(few, months), wh.table("earthquake", months), wh.table("earthquake_fact", months)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        pruned = [p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:]]
        assert any("event_year" in p and "event_month" in p for p in pruned)
    # a revised time does not hide the stored month
    moved = few.withColumn("time", F.col("time") + F.expr("INTERVAL 400 DAYS"))
    assert wh.stored_months(moved) == [(1997, 3)]


def test_keys_start_after_the_stored_highest(built):
    wh, _ = built
    for name, (id_col, _) in S.KEYS.items():
        assert wh.highest_key(name) == wh.table(name).agg(F.max(id_col)).first()[0], name

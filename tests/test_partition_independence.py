"""Same results on 1, 4 and 37 input partitions (T3 sampling, W2 inserts)."""

import pytest

from tremor.operators import profile
from tremor.operators.upsert import insert_only, new_rows
from tremor.plans import pipeline
from tremor.sources.testdata import event_view, fixture_county_edges


@pytest.fixture(scope="module")
def final_rows(spark, sf_small):
    df = pipeline.final_dataset(event_view(spark, sf_small), fixture_county_edges(spark))
    return spark.createDataFrame(df.collect(), df.schema)


@pytest.mark.parametrize("parts", [1, 4, 37])
def test_sample_is_partition_independent(spark, final_rows, parts):
    base = sorted(tuple(r) for r in profile.sample_rows(final_rows.coalesce(1), 80).collect())
    got = sorted(tuple(r) for r in profile.sample_rows(final_rows.repartition(parts), 80).collect())
    assert got == base and len(got) == 80


def test_sample_smaller_than_n(spark, final_rows):
    few = final_rows.limit(5)
    assert profile.sample_rows(few, 80).count() == 5


@pytest.mark.parametrize("parts", [1, 4, 37])
def test_insert_is_partition_independent(spark, final_rows, parts):
    keys = ["state", "county", "region"]
    cands = final_rows.select(*keys).repartition(parts)
    first = final_rows.where("state < 'M'").select(*keys)
    existing, _ = insert_only(first, None, keys, id_col="k")
    table, fresh = insert_only(cands, existing, keys, id_col="k")
    got = sorted(tuple(r) for r in table.select("k", *keys).collect())
    ref_keys = sorted({tuple(r) for r in first.collect()})
    more = sorted({tuple(r) for r in cands.collect()} - set(ref_keys))
    expect = [(i + 1,) + k for i, k in enumerate(ref_keys)]
    expect += [(len(ref_keys) + i + 1,) + k for i, k in enumerate(more)]
    assert got == sorted(expect)
    # a second identical insert adds nothing
    _, again = insert_only(cands, table, keys, id_col="k")
    assert again.count() == 0


def test_semi_join_prefilter_equals_plain_anti_join(spark, final_rows):
    keys = ["earthquake_id"]
    existing = final_rows.where("mag < 3").select(*keys)
    cands = final_rows.select(*keys)
    a = sorted(r[0] for r in new_rows(cands, existing, keys, broadcast_bytes=10**9).collect())
    b = sorted(r[0] for r in new_rows(cands, existing, keys, broadcast_bytes=0).collect())
    assert a == b and len(a) > 0


def test_json_records_format_timestamps(spark, final_rows):
    import json
    rec = profile.to_json_records(profile.sample_head(final_rows, 1)).first()["record"]
    obj = json.loads(rec)
    assert len(obj["time"]) == 19 and obj["time"][10] == " "      # yyyy-MM-dd HH:mm:ss
    assert set(obj) == set(final_rows.columns)

"""What the driver plans with after many rounds: estimated sizes stay numbers of 64 bits."""

from tremor.llm import components as C
from tremor.llm import near_dup
from tremor.llm.common import cut, estimated


def _bits(df):
    return df._jdf.queryExecution().analyzed().stats().sizeInBytes().bit_length()


def _spied(monkeypatch, module, seen):
    """Estimates' bits of all that ``module`` cuts."""
    for name in ("cut", "counted"):
        def call(*args, f=getattr(module, name)):
            out = f(*args)
            seen.append(_bits(out[0] if isinstance(out, tuple) else out))
            return out
        monkeypatch.setattr(module, name, call)


def test_estimates_of_rounds_stay_small(spark):
    df = spark.range(40, numPartitions=3).selectExpr("id", "id % 7 AS k")
    for _ in range(9):
        df = cut(df.join(df.groupBy("id").count(), "id").join(df.selectExpr("id"), "id").select("id", "k"))
        assert _bits(df) <= 64
    assert sorted(df.collect()) == [(i, i % 7) for i in range(40)]


def test_a_size_that_is_known_stays(spark):
    df = spark.range(40).selectExpr("id", "'x' AS v")
    assert _bits(cut(df)) == _bits(df) < 64


def test_order_and_partitions_stay(spark):
    df = spark.range(40, numPartitions=3).selectExpr("id", "id % 7 AS k")
    for _ in range(3):
        df = df.join(cut(df.selectExpr("id")), "id").repartition(2, "k").sortWithinPartitions("k").checkpoint()
    had, has = (d._jdf.queryExecution().analyzed() for d in (df, estimated(df)))
    assert had.stats().sizeInBytes() >= 1 << 63 == has.stats().sizeInBytes() + 1
    for kept in ("outputPartitioning", "outputOrdering", "output", "rdd"):
        assert getattr(had, kept)().toString() == getattr(has, kept)().toString()
    assert sorted(estimated(df).collect()) == sorted(df.collect()) == [(i, i % 7) for i in range(40)]


def test_components_of_a_long_chain(spark, monkeypatch):
    seen = []
    _spied(monkeypatch, C, seen)
    links = spark.createDataFrame([(i * 37 % 200, (i + 1) * 37 % 200) for i in range(199)], "a long, b long")
    found = C.components(links, "a", "b")
    assert max(seen) <= 64 and len(seen) > 5
    assert sorted(map(tuple, found.collect())) == [(i, 0) for i in range(1, 200)]


def test_near_duplicates_of_a_node_that_branches_on(spark, monkeypatch):
    """Texts of one common passage: nodes stay large and apart for several levels."""
    monkeypatch.setattr(near_dup, "SMALL", 4)
    seen, released = [], []
    _spied(monkeypatch, near_dup, seen)
    monkeypatch.setattr(near_dup, "release", released.append)
    common = " ".join(f"c{i}" for i in range(14))
    rows = [(i, f"{common} " + " ".join(f"w{i}x{j}" for j in range(12))) for i in range(24)]
    rows += [(100 + i, f"{t} end{i}") for i, t in rows[:6]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs).collect()}
    assert got == {i: i % 100 for i, _ in rows}
    assert max(seen) <= 64 and len(seen) > 20
    assert set(released) == {spark} and len(released) > 4      # finished levels are let go, too

"""Surrogate keys (W1): dense, natural-key ordered, partition independent."""

import random

import pytest

from tremor.operators.keys import assign_surrogate_keys, number_keys


def _keys(n=500, seed=7):
    rnd = random.Random(seed)
    rows = {(rnd.choice(["a", "B", "c", "Ä", ""]) + str(rnd.randint(0, 40)),
             rnd.choice([0.5, -1.25, 3.0, 2.0, 1e9]), rnd.randint(-3, 3)) for _ in range(n)}
    return sorted(rows)


@pytest.mark.parametrize("in_parts,n_parts", [(1, 1), (4, 4), (37, 5), (3, 37)])
def test_dense_and_ordered(spark, in_parts, n_parts):
    rows = _keys()
    df = spark.createDataFrame(rows, "a string, b double, c int").repartition(in_parts)
    for n in (n_parts, None):
        out, highest = number_keys(df, ["a", "b", "c"], "k", start=100, num_partitions=n)
        got = sorted((r["k"], (r["a"], r["b"], r["c"])) for r in out.collect())
        assert got == [(100 + i + 1, key) for i, key in enumerate(rows)]
        assert highest == 100 + len(rows)


def test_empty_input(spark):
    df = spark.createDataFrame([], "a string")
    assert assign_surrogate_keys(df, ["a"], "k").count() == 0
    assert number_keys(df, ["a"], "k", start=7)[1] == 7

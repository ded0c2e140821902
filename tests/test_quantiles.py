"""Exact distributed quantiles against sorting, and against a million distinct values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tremor.operators.quantiles import exact_quantiles

PROBS = {"lo": 0.0, "p10": 0.1, "q1": 0.25, "mid": 0.5, "p90": 0.9, "hi": 1.0}


def by_sorting(values, p):
    values = sorted(values)
    return values[max(math.ceil(round(p * len(values), 9)), 1) - 1]


@pytest.mark.parametrize("parts", [1, 4, 37])
def test_equals_sorting(spark, parts):
    rnd = random.Random(parts)
    rows = [(rnd.choice(["a", "b", "b", None]), rnd.choice([None, -1.5, 0.0, 2.0, rnd.random()]))
            for _ in range(900)] + [("one", 4.0), ("nulls", None)]
    got = exact_quantiles(spark.createDataFrame(rows, "g string, v double").repartition(parts),
                          ["g"], "v", PROBS).collect()
    want = {}
    for g, v in rows:
        if v is not None:
            want.setdefault(g, []).append(v)
    assert {r["g"]: tuple(r)[1:] for r in got} == {
        g: (len(vs), *(by_sorting(vs, p) for p in PROBS.values())) for g, vs in want.items()}


def test_weights_repeat_values(spark):
    rows = [("a", 1.0, 5), ("a", 2.0, 1), ("a", 3.0, 4), ("b", 7.0, 10**9)]
    got = exact_quantiles(spark.createDataFrame(rows, "g string, v double, n long"), ["g"], "v",
                          PROBS, weight="n").collect()
    assert {r["g"]: tuple(r)[1:] for r in got} == {
        "a": (10, 1.0, 1.0, 1.0, 1.0, 3.0, 3.0), "b": (10**9, *[7.0] * 6)}


def test_over_a_million_distinct_values_in_one_group(spark):
    n = 1_200_000
    # a permutation of 0 .. n-1, so every quantile is known
    df = spark.range(n).select(F.lit("g").alias("g"), ((F.col("id") * 700_001) % n).alias("v"))
    r = exact_quantiles(df, ["g"], "v", PROBS).first()
    assert tuple(r) == ("g", n, *(max(math.ceil(p * n), 1) - 1 for p in PROBS.values()))

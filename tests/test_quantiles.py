"""Exact quantiles by radix selection, against numpy, on values that are hard to tell apart."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogprep.operators import stats as ST

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def kinds():
    rng = random.Random(3)
    step = math.ulp(1.7e9)
    return {
        "neighbours": [1.7e9 + step * rng.randint(0, 40) for _ in range(700)] + [1.7e9 + 1e6],
        "all octaves": [rng.choice([-1, 1]) * 2.0 ** rng.uniform(-1070, 1020) for _ in range(600)],
        "least": [k * 5e-324 for k in range(-200, 200)],
        "hot": [3.25] * 900 + [float(x) for x in range(50)] + [-7.5] * 30,
        "zeros": [0.0, -0.0] * 100 + [1e-300, -1e-300],
        "one": [42.0],
        "equal": [1e308] * 300,
        "heavy tail": [math.exp(rng.gauss(0, 12)) for _ in range(800)],
    }


@pytest.fixture(scope="module")
def values(spark):
    rows = [(k, v) for k, vs in kinds().items() for v in vs] + [(None, 1.0), (None, 2.0), ("nulls", None), ("zeros", None)]
    return spark.createDataFrame(rows, "g string, v double").repartition(7).cache()


@pytest.mark.parametrize("ordered_rows", [1, 40, ST.ORDERED_ROWS])
@pytest.mark.parametrize("few", [True, False])
def test_groups(values, ordered_rows, few):
    got = {(r.g, r.p): (r.n, r.q) for r in ST.exact_quantiles(values, "v", PROBS, ["g"], ordered_rows=ordered_rows, few_groups=few).collect()}
    want = {(k, p): (len(vs), float(np.quantile(vs, p))) for k, vs in kinds().items() for p in PROBS}
    want |= {(None, p): (2, 1.0 + p) for p in PROBS}
    assert set(got) == set(want)
    for k, (n, q) in want.items():
        assert got[k][0] == n and got[k][1] == pytest.approx(q, rel=1e-12, abs=5e-324), k


def test_without_groups_and_with_two(spark, values):
    whole = [v for vs in kinds().values() for v in vs] + [1.0, 2.0]
    got = {r.p: r.q for r in ST.exact_quantiles(values, "v", PROBS, ordered_rows=10).collect()}
    assert got == {p: pytest.approx(float(np.quantile(whole, p)), rel=1e-12) for p in PROBS}
    df = spark.createDataFrame([(a, b, float(a * b + i)) for a in (1, 2) for b in (3, None, 4) if b for i in range(20)] + [(1, None, 5.0)],
                               "a int, b int, v double")
    got = {(r.a, r.b): r.q for r in ST.exact_quantiles(df, "v", [0.5], ["a", "b"], ordered_rows=3).collect()}
    assert got == {(a, b): a * b + 9.5 for a in (1, 2) for b in (3, 4)} | {(1, None): 5.0}


def test_infinite_and_nan_values(spark):
    df = spark.createDataFrame([(v,) for v in (float("nan"), float("inf"), float("-inf"), 1.0, -1.0)], "v double")
    got = {r.p: r.q for r in ST.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.75, 1.0], ordered_rows=1).collect()}
    assert (got[0.0], got[0.25], got[0.5], got[0.75]) == (float("-inf"), -1.0, 1.0, float("inf")) and math.isnan(got[1.0])


def test_first_digit_grows_with_the_value(spark):
    vs = sorted(v for vs in kinds().values() for v in vs)
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(vs)], "i int, v double").select("i", "v", ST._magnitude_cell(F.col("v")).alias("d"))
    digits = [r.d for r in rows.orderBy("i").collect()]
    assert digits == sorted(digits) and max(map(abs, digits)) < ST.CELLS // 2


def test_counters_do_not_grow_with_rows_or_splits(spark):
    df = spark.range(0, 300_000, 1, 40).select((F.col("id") % 1000).cast("double").alias("v"))
    cells = df.groupBy(ST._magnitude_cell(F.col("v"))).count()
    assert cells.count() < 200  # 300,000 rows in 40 splits, under 11 octaves
    assert [r.q for r in ST.exact_quantiles(df, "v", [0.5], ordered_rows=100).collect()] == [499.5]

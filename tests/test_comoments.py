"""Correlations from one block of cross-products, against numpy pair by pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogprep.operators import stats as ST


def brute(data, missing):
    x = np.array(data, float)
    if missing == "listwise":
        x = x[~np.isnan(x).any(axis=1)]
    if missing == "zero_fill":
        x = np.nan_to_num(x)
    out = {}
    for i in range(x.shape[1]):
        for j in range(x.shape[1]):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i], x[both, j]
            flat = len(a) == 0 or np.ptp(a) == 0 or np.ptp(b) == 0
            out[f"c{i}", f"c{j}"] = None if flat else float(np.corrcoef(a, b)[0, 1])
    return out


@pytest.mark.parametrize("missing", ["pairwise", "listwise", "zero_fill"])
def test_policies(spark, missing):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 6)) * [1, 1e-6, 1e6, 1, 1, 1] + [0, 5, 1e9, 0, 0, 0]
    x[:, 3] = x[:, 0] * 2 + 0.1 * x[:, 3]
    x[:, 4] = 0.1  # constant
    x[:, 5] = np.where(x[:, 0] > 0, 7.7, x[:, 5])
    x[rng.random(x.shape) < 0.1] = np.nan
    x[x[:, 0] <= 0, 2] = np.nan  # column 5 is constant where column 2 is present
    rows = [tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(x)]  # nulls and NaN alike
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(6))).repartition(5)
    got = {(r.col_a, r.col_b): r["corr"] for r in ST.corr_matrix(df, missing=missing).collect()}
    want = brute(x, missing)
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == (None if v is None else pytest.approx(v, abs=1e-8)), k


def test_three_hundred_columns(spark):
    df = spark.range(200).select(*[(F.sin(F.col("id") * (i + 1)) + (F.col("id") % 7 if i % 2 else 0)).alias(f"c{i}") for i in range(300)])
    got = ST.corr_matrix(df)
    assert got.count() == 300 * 300
    x = np.array([[r[i] for i in (0, 1, 299)] for r in df.collect()])
    rows = {(r.col_a, r.col_b): r["corr"] for r in got.where("col_a IN ('c0', 'c299') AND col_b IN ('c1', 'c299')").collect()}
    want = np.corrcoef(x.T)
    assert rows["c0", "c1"] == pytest.approx(want[0, 1], abs=1e-9) and rows["c299", "c1"] == pytest.approx(want[2, 1], abs=1e-9)


def test_no_rows_and_one(spark):
    df = spark.createDataFrame([(1.0, 2), (None, 3)], "`a.b` double, n int")
    for part in (df, df.limit(0), df.limit(1)):
        assert {r["corr"] for r in ST.corr_matrix(part, missing="pairwise").where("col_a <> col_b").collect()} == {None}

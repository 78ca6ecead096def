import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogprep.operators import distribution as D
from catalogprep.operators import stats as ST


def test_describe_numeric_exact_quartiles(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "x double")
    r = ST.describe_numeric(df).collect()[0]
    assert (r["count"], r.mean, r.min, r.max) == (4, 2.5, 1.0, 4.0)
    assert (r.p25, r.p50, r.p75) == (1.75, 2.5, 3.25)  # pandas / numpy linear
    assert math.isclose(r.std, np.std([1, 2, 3, 4], ddof=1))


def test_describe_all_categorical(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "s string, n int")
    rows = {r.column_name: r for r in ST.describe_all(df).collect()}
    assert (rows["s"]["count"], rows["s"].unique, rows["s"].top, rows["s"].freq) == (3, 2, "a", 2)
    assert rows["n"].mean == 2.5 and rows["n"].top is None


def test_corr_policies_and_constant_column(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, None, 5.0), (4.0, 8.3, 5.0), (None, 1.0, 5.0)]
    df = spark.createDataFrame(rows, "x double, y double, k double")
    pair = {(r.col_a, r.col_b): r.corr for r in ST.corr_matrix(df, missing="pairwise").collect()}
    assert pair[("x", "k")] is None  # constant: no division by zero
    assert math.isclose(pair[("x", "y")], np.corrcoef([1, 2, 4], [2, 4.1, 8.3])[0, 1])
    assert math.isclose(pair[("x", "x")], 1.0)
    zero = {(r.col_a, r.col_b): r.corr for r in ST.corr_matrix(df, missing="zero_fill").collect()}
    xs, ys = [1, 2, 3, 4, 0], [2, 4.1, 0, 8.3, 1]
    assert math.isclose(zero[("y", "x")], np.corrcoef(xs, ys)[0, 1])
    lw = ST.corr_matrix(df, ["x", "y"], missing="listwise").collect()
    assert len(lw) == 4


def test_histogram_matches_numpy_edges(spark):
    vals = [0.0, 1.0, 2.5, 9.9, 10.0, 3.3, 7.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r.n for r in D.histogram(df, "v", 10).orderBy("bin").collect()]
    assert got == list(np.histogram(vals, bins=10)[0])


def test_histogram_min_equals_max(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    got = [(r.bin, r.n) for r in D.histogram(df, "v", 10).orderBy("bin").collect() if r.n]
    counts, _ = np.histogram([3.0, 3.0], bins=10)
    assert got == [(int(np.argmax(counts)), 2)]


@pytest.mark.parametrize("exact", [False, True])
@pytest.mark.parametrize("vals", [[1.0, 2.0, 2.0, 3.5, 7.0], [float(i * i % 977) for i in range(3000)], [0.0] * 500 + [1e6], [-1e-9, 1e-9, 3e-9]])
def test_kde_matches_direct_formula(spark, vals, exact):
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "v double").repartition(3)
    got = D.kde_grid(df, "v", points=50, exact=exact).orderBy("i").collect()
    x = np.array(vals)
    bw = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - 3 * bw, x.max() + 3 * bw, 50)
    dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / bw) ** 2).sum(1) / (len(x) * bw * math.sqrt(2 * math.pi))
    bound = 1e-14 if exact else D.kde_error_bound() + 1e-14
    assert D.kde_error_bound() < 1e-12
    assert np.abs(np.array([r.density for r in got]) - dens).max() <= bound / (bw * math.sqrt(2 * math.pi))
    assert np.allclose([r.x for r in got], grid)


def test_density_without_a_bandwidth_or_rows(spark):
    one = D.kde_grid(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v", points=5).orderBy("i").collect()
    assert [(r.i, r.x, r.density) for r in one] == [(i, 3.0, None) for i in range(5)]
    assert D.kde_grid(spark.createDataFrame([(None,)], "v double"), "v", points=5).count() == 0


def test_density_repeats_no_row(spark):
    df = spark.range(5000).select((F.col("id") % 701).cast("double").alias("v")).repartition(3)
    plan = D.kde_grid(df, "v")._jdf.queryExecution().optimizedPlan().toString()
    # cells are made before anything is repeated per grid point (plans are printed from the result down)
    assert plan.index("Generate explode") < plan.index("Aggregate [cell")


def test_boxplot_stats_matplotlib_rule(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([("g", v) for v in vals], "g string, v double")
    r = D.boxplot_stats(df, "g", "v").collect()[0]
    q1, med, q3 = np.percentile(vals, [25, 50, 75])
    assert (r.q1, r.median, r.q3) == (q1, med, q3)
    assert (r.whisker_lo, r.whisker_hi, r.n_outliers, r.n) == (1.0, 5.0, 1, 6)


def test_binned_scatter_counts_all_rows(spark):
    df = spark.createDataFrame([(float(i), float(i * i)) for i in range(100)], "x double, y double")
    got = D.binned_scatter(df, "x", "y", bins_x=5, bins_y=5).collect()
    assert sum(r.n for r in got) == 100
    assert max(r.bx for r in got) == 4 and max(r.by for r in got) == 4


def test_exact_quantiles_small_and_refined(spark):
    import random

    rnd = random.Random(7)
    vals = [round(rnd.gauss(0, 1), 3) for _ in range(3000)] + [0.5] * 1000  # a hot value
    df = spark.createDataFrame([("g", v) for v in vals] + [("h", 1.0), ("h", 3.0)], "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    for rows in (100_000, 100):  # 100: cells are refined
        got = {(r.g, r.p): r.q for r in ST.exact_quantiles(df, "v", probs, ["g"], ordered_rows=rows).collect()}
        for p in probs:
            assert math.isclose(got[("g", p)], float(np.quantile(vals, p)), abs_tol=1e-12), (rows, p)
            assert math.isclose(got[("h", p)], float(np.quantile([1.0, 3.0], p)))


def test_empty_and_single_row_statistics(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert ST.exact_quantiles(empty, "v", [0.5], ["g"]).count() == 0
    assert [r.n for r in D.histogram(empty, "v", 3).collect()] == [0, 0, 0]
    one = spark.createDataFrame([("a", 2.0)], "g string, v double")
    r = ST.describe_numeric(one.select("v")).collect()[0]
    assert (r["count"], r.mean, r.std, r.p25, r.p50, r.p75) == (1, 2.0, None, 2.0, 2.0, 2.0)
    b = D.boxplot_stats(one, "g", "v").collect()[0]
    assert (b.n, b.q1, b.median, b.q3, b.whisker_lo, b.whisker_hi, b.n_outliers) == (1, 2.0, 2.0, 2.0, 2.0, 2.0, 0)
    assert [r.n for r in D.histogram(one, "v", 4).orderBy("bin").collect()] == list(np.histogram([2.0], bins=4)[0])

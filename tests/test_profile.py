from catalogprep.operators import profile as P


def _df(spark):
    rows = [("Movie", "PG"), ("Movie", "R"), ("Movie", "PG"), ("TV Show", "PG"), ("TV Show", None), (None, "R")]
    return spark.createDataFrame(rows, "type string, rating string")


def test_value_counts_drop_null_keys_and_order(spark):
    got = [tuple(r) for r in P.value_counts(_df(spark), "rating").collect()]
    assert got == [("PG", 3), ("R", 2)]
    by_value = [tuple(r) for r in P.value_counts(_df(spark), "type", sort="value").collect()]
    assert by_value == [("Movie", 3), ("TV Show", 2)]


def test_pivot_counts_fills_zero_and_totals(spark):
    got = {r.type: (r.PG, r.R, r.total) for r in P.pivot_counts(_df(spark), "type", "rating").collect()}
    assert got == {"Movie": (2, 1, 3), "TV Show": (1, 0, 1)}


def test_pivot_domain_bound(spark):
    import pytest

    with pytest.raises(ValueError):  # a cap is the caller's
        P.pivot_counts(_df(spark), "type", "rating", max_values=1)


def test_crosstab_and_row_share(spark):
    ct = {r.type: (r.PG, r.R) for r in P.crosstab(_df(spark), "type", "rating").collect()}
    assert ct == {"Movie": (2, 1), "TV Show": (1, 0)}
    share = {(r.type, r.rating): r.share for r in P.row_share(_df(spark), "type", "rating").collect()}
    assert share == {("Movie", "PG"): 2 / 3, ("Movie", "R"): 1 / 3, ("TV Show", "PG"): 1.0}


def test_percent_share(spark):
    got = {r.rating: r.pct for r in P.percent_share(_df(spark), "rating").collect()}
    assert got == {"PG": 60.0, "R": 40.0}


def test_reindex_keeps_order_and_missing_labels(spark):
    counts = P.value_counts(_df(spark), "rating", sort="none")
    got = [tuple(r) for r in P.reindex(counts, "rating", ["R", "G", "PG"]).orderBy("ord").collect()]
    assert got == [("R", 0, 2), ("G", 1, None), ("PG", 2, 3)]


def test_top_n_ties_broken_by_value(spark):
    df = spark.createDataFrame([(x,) for x in "aabbccd"], "v string")
    assert [r.v for r in P.top_n(df, "v", 2).collect()] == ["a", "b"]


def test_top_n_per_group(spark):
    df = spark.createDataFrame(
        [("g1", "a"), ("g1", "a"), ("g1", "b"), ("g1", "c"), ("g2", "z"), ("g2", "y")], "g string, v string"
    )
    got = sorted((r.g, r.v, r.rank) for r in P.top_n_per_group(df, "g", "v", 2).collect())
    assert got == [("g1", "a", 1), ("g1", "b", 2), ("g2", "y", 1), ("g2", "z", 2)]


def test_semi_filter_and_outer_align(spark):
    df = spark.createDataFrame([(x, i) for i, x in enumerate("aaabbc")], "k string, i int")
    assert sorted(r.k for r in P.semi_filter_top(df, "k", 1).collect()) == ["a", "a", "a"]
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n_movie long")
    right = spark.createDataFrame([("b", 5), ("c", 7)], "k string, n_tv_show long")
    got = sorted(tuple(r) for r in P.outer_align(left, right, "k", "n_movie", "n_tv_show").collect())
    assert got == [("a", 1, 0), ("b", 2, 5), ("c", 0, 7)]


def test_recent_window_and_label(spark):
    df = spark.createDataFrame([(y, t) for y, t in [(1989, 10), (2018, 60), (2020, 40)]], "year int, total long")
    got = sorted(tuple(r) for r in P.label_threshold(P.recent_window(df, "year", 30), "total", 50).collect())
    assert got == [(2018, 60, True), (2020, 40, False)]

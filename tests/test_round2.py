"""Edge cases and plans settled in the second round."""

import pytest
from pyspark.sql import functions as F

from catalogprep.operators import distribution as D
from catalogprep.operators import features as FE
from catalogprep.operators import multivalue as M
from catalogprep.operators import profile as P
from catalogprep.operators import quality as Q
from catalogprep.operators import stats as ST


def _lookups(spark):
    valid = spark.createDataFrame([("A",), ("B",)], "country string")
    langs = spark.createDataFrame([("A", ["x", None]), ("A", ["y"]), ("B", None), ("C", ["z", None])],
                                  "country string, Languages array<string>")
    return valid, langs


@pytest.mark.parametrize("mode", ["keep_all", "compat"])
def test_both_lookup_paths_agree(spark, mode):
    rows = [(1, None), (2, ""), (3, "A, A"), (4, "A, B, Q"), (5, "C"), (6, ", A"), (7, "Unknown"), (3, "A, A")]
    df = spark.createDataFrame(rows, "id int, country string")
    out = [sorted(map(repr, M.enrich_languages(df, *_lookups(spark), mode=mode, max_lookup_rows=n).collect()))
           for n in (1000, 0)]
    assert out[0] == out[1]
    assert not any("None]" in r or "[None" in r for r in out[0])  # a null language is no language


def test_null_list_stays_null(spark):
    df = spark.createDataFrame([(1, None)], "id int, country string")
    for n in (1000, 0):
        row = M.enrich_languages(df, *_lookups(spark), mode="keep_all", max_lookup_rows=n).first()
        assert row.released_countries is None and row.released_languages is None


def test_profiles_compile(spark):
    df = spark.range(5).select("id", F.lit(None).cast("string").alias("s"))
    old = spark.conf.get("spark.sql.codegen.fallback")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        assert [r.nulls_after_fill for r in Q.fill_profile(df, {"s": "x"}).orderBy("position").collect()] == [0, 0]
        assert [r.null_count for r in Q.null_profile(df).orderBy("position").collect()] == [0, 5]
        assert [r.non_null_count for r in Q.schema_report(df).orderBy("position").collect()] == [5, 0]
    finally:
        spark.conf.set("spark.sql.codegen.fallback", old)


def test_density_of_constant_single_and_empty_columns(spark):
    for values in ([2.0, 2.0, 2.0], [2.0]):
        rows = D.kde_grid(spark.createDataFrame([(v,) for v in values], "v double"), "v", points=5).collect()
        assert len(rows) == 5 and {r.x for r in rows} == {2.0} and {r.density for r in rows} == {None}
    assert D.kde_grid(spark.createDataFrame([(None,)], "v double"), "v", points=5).count() == 0


def test_wide_output_has_no_cap(spark):
    df = spark.range(1200).select(F.lit(1).alias("r"), F.col("id").cast("string").alias("c"))
    assert len(P.crosstab(df, "r", "c").columns) == 1201
    assert FE.one_hot_long(df, "r", "c").count() == 1200


def test_shares_and_pairs_read_once(spark):
    df = spark.createDataFrame([(float(i), float(i % 3), i % 2) for i in range(30)], "a double, b double, c int")
    shares = P.percent_share(df, "c")
    assert sum(r.pct for r in shares.collect()) == pytest.approx(100)
    pairs = D.pair_binned_counts(df, ["a", "b", "c"], bins=4)
    assert pairs.agg(F.sum("n")).first()[0] == 90


def test_tfidf_shares_its_counts(spark):
    df = spark.createDataFrame([(1, "red blue red"), (2, "blue green"), (3, None), (4, "")], "id int, t string")
    out = FE.tfidf(df, "id", "t")
    assert out.count() == 4
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "ReusedExchange" in plan and final.count("Generate explode") == 1


def test_title_features(spark):
    rows = [("s1", "Movie", ["a", "b"], "2020-01-06", 90, None, "red blue"), ("s2", None, None, None, None, 2, None)]
    df = spark.createDataFrame(rows, "show_id string, type string, genres array<string>, added_date string, "
                                     "movie_duration int, seasons int, description string")
    out = FE.title_features(df, categorical={"type": ["Movie"]}, lists={"genres": ["a", "c"]},
                            numeric=("movie_duration", "seasons"))
    got = {r.show_id: r for r in out.collect()}
    assert (got["s1"].type_Movie, got["s1"].genres_a, got["s1"].genres_c, got["s1"].added_dayofweek) == (1, 1, 0, 0)
    assert (got["s2"].type_Movie, got["s2"].genres_a, got["s2"].added_year, got["s2"].tfidf_idx) == (0, 0, None, None)


def test_quantiles_of_two_kinds_of_values(spark):
    import random

    rng = random.Random(11)
    values = [rng.choice([rng.random() * 1000, float(rng.randint(0, 9))]) for _ in range(6000)] + [5.0] * 3000
    df = spark.createDataFrame([("g", v) for v in values] + [("h", 1.0), ("i", None)], "g string, v double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    want = df.where("g = 'g'").agg(F.percentile("v", F.array(*map(F.lit, probs)))).first()[0]
    for rows in (1, 50, 400, 100_000):
        got = {(r.g, r.p): r.q for r in ST.exact_quantiles(df, "v", probs, ["g"], ordered_rows=rows).collect()}
        assert [got["g", p] for p in probs] == pytest.approx(want) and got["h", 0.5] == 1.0 and len(got) == 12
    assert [r.q for r in ST.exact_quantiles(df, "v", [0.5], ordered_rows=100).collect()] == pytest.approx(
        [df.agg(F.percentile("v", 0.5)).first()[0]])

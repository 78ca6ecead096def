import math
from collections import Counter

import numpy as np

from catalogprep.operators import features as FE
from catalogprep.operators import text as TX


def test_one_hot_like_get_dummies(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, t string")
    out = FE.one_hot(df, "t")
    assert out.columns == ["id", "t_a", "t_b"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 0, 1), (2, 1, 0), (3, 0, 0)]


def test_multi_hot_sorted_labels(spark):
    df = spark.createDataFrame([(1, ["y", "x"]), (2, ["z"]), (3, [])], "id int, g array<string>")
    out = FE.multi_hot(df, "g")
    assert out.columns == ["id", "g_x", "g_y", "g_z"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 1, 1, 0), (2, 0, 0, 1), (3, 0, 0, 0)]
    long = sorted(tuple(r) for r in FE.multi_hot_long(df, "id", "g").collect())
    assert long == [(1, "g_x", 1), (1, "g_y", 1), (2, "g_z", 1)]


def test_standard_scale_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, None), (4.0, 5.0)], "x double, k double")
    out = FE.standard_scale(df, ["x", "k"]).collect()
    xs = np.array([1.0, 2.0, 3.0, 4.0])
    assert np.allclose([r.x for r in out], (xs - xs.mean()) / xs.std())
    assert [r.k for r in out] == [0.0, 0.0, None, 0.0]  # zero std divides by 1, missing kept


def _sk_tfidf(docs, max_features, stop):
    """scikit-learn's TfidfVectorizer conventions, written out with numpy."""
    import re

    toks = [[t for t in re.findall(r"(?u)\b\w\w+\b", d.lower()) if t not in stop] for d in docs]
    total = Counter(t for ts in toks for t in ts)
    vocab = sorted(total, key=lambda t: (-total[t], t))[:max_features]
    df = Counter(t for ts in toks for t in set(ts) if t in vocab)
    n = len(docs)
    out = {}
    for i, ts in enumerate(toks):
        c = Counter(t for t in ts if t in vocab)
        raw = {t: c[t] * (math.log((1 + n) / (1 + df[t])) + 1) for t in c}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        for t, v in raw.items():
            out[(i, t)] = v / norm
    return out


def test_tfidf_sklearn_conventions(spark):
    docs = ["The cat sat on the mat", "the dog sat", "cat and dog and cat", "", "Éclair éclair mat"]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, text string")
    got = {(r.id, r.term): r.weight for r in FE.tfidf(df, "id", "text", max_features=4).collect()}
    from catalogprep.functions.text import ENGLISH_STOP_WORDS

    want = _sk_tfidf(docs, 4, set(ENGLISH_STOP_WORDS))
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k]) for k in want)


def test_tfidf_index_column(spark):
    df = spark.createDataFrame([(0, "b a c"), (1, "aa bb")], "id int, text string")
    got = {r.term: r.idx for r in FE.tfidf(df, "id", "text", index_col="idx").collect()}
    assert got == {"aa": 0, "bb": 1}


def test_term_and_bigram_freq(spark):
    df = spark.createDataFrame(
        [("The hero's journey: a hero meets 42 friends",), ("Hero friends and hero enemies",)], "t string"
    )
    terms = {r.term: (r.n, r.weight) for r in TX.term_freq(df, "t").collect()}
    assert terms["hero"] == (4, 1.0)
    assert "42" not in terms and "the" not in terms and "and" not in terms
    bigrams = {r.bigram: r.n for r in TX.bigram_freq(df, "t").collect()}
    assert bigrams == {"hero journey": 1, "journey hero": 1, "hero meets": 1, "meets friends": 1, "hero friends": 1,
                       "hero enemies": 1}


def test_calendar_features(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.date(2021, 3, 14),)], "added_date date")
    r = FE.calendar_features(df, "added_date").collect()[0]
    assert tuple(r) == (2021, 3, 14, 6)


def test_label_domains_of_all_columns_in_one_job(spark):
    df = spark.createDataFrame([(1, "b", ["y", "x"], 5), (2, "a", ["z", None], None), (3, None, None, 7), (4, "a", [], 5)],
                               "id int, t string, g array<string>, n int").repartition(3)
    assert FE.wide_domains(df, ["t", "n"], ["g"]) == {"t": ["a", "b"], "n": ["5", "7"], "g": ["x", "y", "z"]}
    assert FE.wide_domains(df, ["t", "n"], ["g"], max_wide=2) == {"t": ["a", "b"], "n": ["5", "7"], "g": None}
    assert FE.wide_domains(df.limit(0), ["t"], ["g"]) == {"t": [], "g": []} and FE.wide_domains(df) == {}
    got = {r.id: r.g_idx for r in FE.sparse_labels(df, "id", "g", is_list=True).collect()}
    assert got == {1: [0, 1], 2: [2]}


def test_title_features_without_value_lists(spark):
    rows = [("s1", "Movie", ["a", "b"], "2020-01-06", 90, None, "red blue"), ("s2", None, None, None, None, 2, None),
            ("s3", "Show", ["c", "b", None], None, None, 2, "blue")]
    df = spark.createDataFrame(rows, "show_id string, type string, genres array<string>, added_date string, "
                                     "movie_duration int, seasons int, description string")
    wide = FE.title_features(df, categorical={"type": None}, lists={"genres": None}, numeric=("seasons",))
    given = FE.title_features(df, categorical={"type": ["Movie", "Show"]}, lists={"genres": ["a", "b", "c"]}, numeric=("seasons",))
    assert wide.columns == given.columns and sorted(wide.collect()) == sorted(given.collect())
    sparse = {r.show_id: r for r in FE.title_features(df, categorical={"type": None}, lists={"genres": None}, numeric=("seasons",), max_wide=2).collect()}
    assert (sparse["s1"].genres_idx, sparse["s2"].genres_idx, sparse["s3"].genres_idx) == ([0, 1], None, [1, 2])
    assert (sparse["s1"].type_Movie, sparse["s3"].type_Show) == (1, 1)


def test_stop_words_of_another_list_and_of_the_corpus(spark):
    docs = ["the cat sat", "the dog sat", "the cat and a dog", "", None]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, text string")
    own = FE.frequent_terms(df, "id", "text", 0.5)
    assert {(r.term, r.df) for r in own.collect()} == {("the", 3)}
    for stop in (["the"], own, own.unionByName(own)):
        got = {(r.id, r.term): r.weight for r in FE.tfidf(df, "id", "text", stop_words=stop).collect()}
        want = _sk_tfidf([d or "" for d in docs], 100, {"the"})
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_sparse_text_shuffles_no_row_per_id_and_term(spark):
    df = spark.createDataFrame([(i, f"red blue t{i} blue") for i in range(20)], "id int, text string").repartition(3)
    assert _exchanges(FE.sparse_text(df, "id", "text", 5)) == 0


def test_tfidf_of_rows_that_share_an_id(spark):
    # they are one document, but each of them counts among the rows
    rows = [(1, "cat dog"), (1, "cat owl"), (2, "dog"), (None, "owl"), (None, "owl cat"), (3, "the"), (4, None), (4, "")]
    df = spark.createDataFrame(rows, "id int, text string").repartition(3)
    tf = {1: Counter(cat=2, dog=1, owl=1), 2: Counter(dog=1), None: Counter(owl=2, cat=1)}
    n, seen = len(rows), Counter(t for c in tf.values() for t in c)
    want = {}
    for i, c in tf.items():
        raw = {t: k * (math.log((1 + n) / (1 + seen[t])) + 1) for t, k in c.items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        want |= {(i, t): x / norm for t, x in raw.items()}
    for most in (10, None):
        got = FE.tfidf(df, "id", "text", max_features=most).collect()
        assert len(got) == len(want)
        assert all(math.isclose(r.weight, want[r.id, r.term]) for r in got)
    sparse = {r.id: r for r in FE.sparse_text(df, "id", "text").collect() if r.tfidf_idx}
    assert sparse[1].tfidf_idx == [0, 1, 2] and math.isclose(sparse[1].tfidf_val[0], want[1, "cat"]) and set(sparse) == set(tf)

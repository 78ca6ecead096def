"""Features fitted on one table and applied to another, against the formulas by hand."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from catalogprep.operators import fitted

SCHEMA = "id string, size double, votes int, kind string, genres array<string>, about string, label string, idx int"
KNOWN = [
    ("a", 10.0, 1, "Movie", ["x", "y", "x"], "red fish blue fish", "clash", 0),
    ("b", 20.0, 1, "Show", ["z"], "blue sky", "clash", 0),
    ("c", None, 1, None, None, None, "clash", 0),
    ("d", 60.0, None, "Movie", [None, "y"], "the red sea", "clash", 0),
]
OTHER = [
    ("p", 30.0, 2, "Show", ["y", "new"], "red red unknown", "clash", 0),
    ("q", None, None, "Unheard", [], "nothing known here", "clash", 0),
    ("r", float("nan"), None, None, None, None, "clash", 0),
    ("s", 10.0, 0, "Movie", ["x"], "", "clash", 0),
]
SPEC = fitted.FeatureSpec("id", numeric=("size", "votes"), categorical=("kind",), lists=("genres",), text="about", max_features=4,
                          stop_words=("the",))


def brute(known, others, spec):
    at = {"id": 0, "size": 1, "votes": 2, "kind": 3, "genres": 4, "about": 5}
    names, moments = [], []
    for c in spec.numeric:
        xs = [r[at[c]] for r in known if r[at[c]] is not None]
        names.append((c, None))
        moments.append((float(np.mean(xs)) if xs else 0.0, float(np.std(xs)) if xs and np.std(xs) > 0 else 1.0))
    for c in (*spec.categorical, *spec.lists):
        seen = [x for r in known for x in (r[at[c]] if c in spec.lists else [r[at[c]]]) or [] if x is not None]
        names += [(c, x) for x in sorted(set(seen))]
    words = lambda t: Counter(w for w in re.findall(r"\w{2,}", (t or "").lower()) if w not in spec.stop_words)
    total, df = Counter(), Counter()
    for r in known:
        total.update(words(r[5]))
        df.update(set(words(r[5])))
    terms = sorted(sorted(total, key=lambda t: (-total[t], t))[:spec.max_features]) if spec.text else []
    idf = {t: math.log((1 + len(known)) / (1 + df[t])) + 1 for t in terms}
    place = {n: i for i, n in enumerate(names + [("about", t) for t in terms])}
    out = {}
    for r in others:
        v = {place[c, None]: (r[at[c]] - m) / s for c, (m, s) in zip(spec.numeric, moments) if r[at[c]] is not None}
        for c in (*spec.categorical, *spec.lists):
            for x in (r[at[c]] if c in spec.lists else [r[at[c]]]) or []:
                if (c, x) in place:
                    v[place[c, x]] = 1.0
        w = {t: n * idf[t] for t, n in words(r[5]).items() if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        v |= {place["about", t]: x / norm for t, x in w.items()}
        out[r[0]] = sorted(v.items())
    return out


@pytest.mark.parametrize("spec", [SPEC, fitted.FeatureSpec("id", categorical=("kind",)), fitted.FeatureSpec("id", lists=("genres",)),
                                  fitted.FeatureSpec("id", numeric=("votes",)), fitted.FeatureSpec("id", text="about", stop_words=())])
def test_fit_on_one_table_applied_to_another(spark, tmp_dir, spec):
    fitted.fit_features(spark.createDataFrame(KNOWN, SCHEMA).repartition(3), spec, tmp_dir)
    assert fitted.fitted_spec(spark, tmp_dir) == spec
    for rows in (OTHER, KNOWN):
        got = fitted.transform_features(spark.createDataFrame(rows, SCHEMA).repartition(2), tmp_dir).collect()
        want = brute(KNOWN, rows, spec)
        assert len(got) == len(rows)
        for r in got:
            assert r.idx == [i for i, _ in want[r.id]]
            assert r.val == pytest.approx([x for _, x in want[r.id]], nan_ok=True)


def test_features_are_kept_in_order_and_can_be_fitted_anew(spark, tmp_dir):
    fitted.fit_features(spark.createDataFrame(KNOWN, SCHEMA), SPEC, tmp_dir)
    rows = fitted.fitted_features(spark, tmp_dir).orderBy("idx").collect()
    assert [(r.idx, r.kind, r.column, r.label) for r in rows] == [
        (0, "number", "size", None), (1, "number", "votes", None), (2, "label", "kind", "Movie"), (3, "label", "kind", "Show"),
        (4, "label", "genres", "x"), (5, "label", "genres", "y"), (6, "label", "genres", "z"),
        (7, "term", "about", "blue"), (8, "term", "about", "fish"), (9, "term", "about", "red"), (10, "term", "about", "sea")]
    fitted.fit_features(spark.createDataFrame(OTHER, SCHEMA), SPEC, tmp_dir)
    assert {r.label for r in fitted.fitted_features(spark, tmp_dir).where("column = 'kind'").collect()} == {"Movie", "Show", "Unheard"}


def test_nothing_to_fit_and_nothing_to_transform(spark, tmp_dir):
    empty, full = spark.createDataFrame([], SCHEMA), spark.createDataFrame(OTHER, SCHEMA)
    fitted.fit_features(empty, SPEC, tmp_dir + "/a")
    got = {r.id: list(zip(r.idx, r.val)) for r in fitted.transform_features(full, tmp_dir + "/a").collect()}
    assert got["p"] == [(0, 30.0), (1, 2.0)] and got["q"] == []
    fitted.fit_features(full, SPEC, tmp_dir + "/b")
    assert fitted.transform_features(empty, tmp_dir + "/b").count() == 0


def test_domains_of_all_columns_take_one_shuffle(spark):
    spec = fitted.FeatureSpec("id", categorical=("kind", "label"), lists=("genres",))
    plan = fitted.label_domains(spark.createDataFrame(KNOWN, SCHEMA), spec)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("partial_count") == 1


def test_transform_weighs_terms_within_the_row(spark, tmp_dir):
    """No shuffle of a row per id and term, and the norm is found once a row, not once a term."""
    spec = fitted.FeatureSpec("id", text="about", stop_words=())
    fitted.fit_features(spark.createDataFrame(KNOWN, SCHEMA), spec, tmp_dir)
    plan = fitted.transform_features(spark.createDataFrame(OTHER, SCHEMA), tmp_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and "explode(" not in plan


def test_rows_that_share_an_id_are_one(spark, tmp_dir):
    rows = [("a", "red red"), ("a", "blue"), ("b", "blue"), (None, "red"), (None, "sky"), ("c", None)]
    df = spark.createDataFrame(rows, "id string, about string").repartition(3)
    fitted.fit_features(df, fitted.FeatureSpec("id", text="about", stop_words=()), tmp_dir)
    idf = {r.label: r.idf for r in fitted.fitted_features(spark, tmp_dir).collect()}
    assert idf == pytest.approx({t: math.log(7 / (1 + k)) + 1 for t, k in {"red": 2, "blue": 2, "sky": 1}.items()})
    got = {r.id: (r.idx, r.val) for r in fitted.transform_features(df, tmp_dir).collect()}
    assert {k: v[0] for k, v in got.items()} == {"a": [0, 1], "b": [0], None: [1, 2], "c": []}
    norm = math.hypot(idf["blue"], 2 * idf["red"])
    assert got["a"][1] == pytest.approx([idf["blue"] / norm, 2 * idf["red"] / norm])

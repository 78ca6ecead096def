"""Top-N by summaries: equal to a full count on skewed and on flat keys."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalogprep.operators import heavy


def brute(rows, n):
    by_group = {}
    for g, k in rows:
        if g is not None and k is not None:
            by_group.setdefault(g, Counter())[k] += 1
    return {(g, k, c, i + 1) for g, counts in by_group.items()
            for i, (k, c) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:n])}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = [("skewed", f"k{min(int(rng.paretovariate(0.9)), 5000)}") for _ in range(6000)]
    out += [("flat", f"f{i % 1500}") for i in range(4500)] + [("few", rng.choice("abc")) for _ in range(400)]
    return out + [("few", None), (None, "a"), ("none", None), ("one", "x"), ("ties", "t1"), ("ties", "t2"), ("ties", "t3")]


@pytest.mark.parametrize("tracked", [16, 200, heavy.TRACKED])
def test_groups_equal_a_full_count(spark, rows, tracked):
    df = spark.createDataFrame(rows, "g string, k string").repartition(6)
    got = heavy.top_n_by_summary(df, "k", 2, groups=["g"], tracked=tracked, mergers=3)
    assert {tuple(r) for r in got.collect()} == brute(rows, 2)


@pytest.mark.parametrize("group,tracked,certified", [("skewed", 200, True), ("flat", 200, False), ("few", 16, True), ("none", 16, True)])
def test_certificate_and_the_exact_way_out(spark, rows, group, tracked, certified):
    some = [r for r in rows if r[0] == group]
    df = spark.createDataFrame(some, "g string, k string").repartition(4)
    got = heavy.top_n_by_summary(df, "k", 3, tracked=tracked)
    assert {(group, *r) for r in got.collect()} == brute(some, 3)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("left_anti" not in plan.lower().replace("leftanti", "left_anti")) == certified


def test_only_candidates_are_shuffled(spark, rows):
    df = spark.createDataFrame([(k,) for _, k in rows if k], "k string").repartition(4).cache()
    distinct = df.distinct().count()
    found = heavy.candidates(df.withColumn("a", F.lit(1)), "k", ["a"], tracked=64).collect()
    assert 0 < len(found) <= 64 < distinct / 10
    full = dict(Counter(k for _, k in rows if k))
    missing = max(c for k, c in full.items() if k not in {r.k for r in found})
    assert missing <= found[0].bound  # no key outside is above the bound


def test_numbers_and_empty(spark):
    df = spark.createDataFrame([(5,), (5,), (4,), (4,), (3,), (None,)], "k int")
    assert [tuple(r) for r in heavy.top_n_by_summary(df, "k", 2).orderBy("rank").collect()] == [(4, 2, 1), (5, 2, 2)]
    assert heavy.top_n_by_summary(df.limit(0), "k", 2).count() == 0

"""Word and collocation ranking against brute force on small texts."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from catalogprep.operators import ranking

STOP = ("the", "of", "it's")


def brute(texts, pairs=True, threshold=30.0, plurals=True, stop=STOP):
    """The whole ranking over lists in memory: {(term, kind): (n, score)}."""
    words, twos = Counter(), Counter()
    for text in texts:
        w = re.findall(r"\w[\w']*", text or "")
        w = [x[:-2] if x.lower().endswith("'s") else x for x in w]
        w = [x for x in w if x and not x.isdigit()]
        ok = [x.lower() not in stop for x in w]
        words.update(x for x, k in zip(w, ok) if k)
        twos.update(f"{a} {b}" for a, b, k, m in zip(w, w[1:], ok, ok[1:]) if k and m)

    def plural(key):
        return plurals and len(key) > 1 and key.endswith("s") and not key.endswith("ss")

    def stem(key):
        return key[:-1] if plural(key) else key

    def fold(counts):
        keys = {f.lower() for f in counts}
        spelled = defaultdict(Counter)
        for form, n in counts.items():
            key = form.lower()
            merge = plural(key) and key[:-1] in keys
            spelled[stem(key)][form[:-1] if merge else form] += n
        return {k: (min(c.items(), key=lambda x: (-x[1], x[0]))[0], sum(c.values())) for k, c in spelled.items()}

    singles, doubles = fold(words), fold(twos)
    left = {k: n for k, (_, n) in singles.items()}
    total = sum(left.values())
    count = dict(left)
    out = {}
    log = lambda k, n, x: math.log(max(x, 1e-10)) * k + math.log(max(1 - x, 1e-10)) * (n - k)
    for term, c in doubles.values() if pairs else ():
        s, t = (stem(x.lower()) for x in term.split(" "))
        a, b = count[s], count[t]
        if total <= a or total <= b:
            continue
        score = -2 * (log(c, a, b / total) + log(b - c, total - a, b / total) - log(c, a, c / a) - log(b - c, total - a, (b - c) / (total - a)))
        if score > threshold:
            out[(term, "pair")] = (c, score)
            left[s] -= c
            left[t] -= c
    out.update({(singles[k][0], "word"): (n, None) for k, n in left.items() if n > 0})
    return out


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)


def got(df):
    return {(r.term, r.kind): (r.n, r.score) for r in df.collect()}


@pytest.mark.parametrize("pairs,plurals,threshold", [(True, True, 30.0), (True, True, 3.0), (True, False, 3.0), (False, True, 30.0)])
def test_ranking_against_brute_force(spark, pairs, plurals, threshold):
    rng = random.Random(4)
    vocabulary = ["Movie", "movies", "MOVIES", "movie", "glass", "glas", "boss", "bos", "S", "s", "new", "New", "York", "Cats", "cats", "CATS",
                  "dog's", "dog", "dogs", "the", "of", "It's", "1999", "é", "És", "a's", "'s", "x1"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 30))) for _ in range(60)]
    texts += ["new york new york"] * 9 + ["New York movies"] * 8 + [None, "", "1 2 3", "the of"]
    df = ranking.word_ranking(frame(spark, texts), "text", top=10_000, pairs=pairs, plurals=plurals, threshold=threshold, stop_words=STOP)
    want = brute(texts, pairs, threshold, plurals)
    found = got(df)
    assert {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in want.items()}
    for k, (_, score) in want.items():
        assert found[k][1] == (None if score is None else pytest.approx(score, rel=1e-9))
    if pairs:
        assert any(k[1] == "pair" for k in want)


def test_ties_and_plurals(spark):
    rows = got(ranking.word_ranking(frame(spark, ["Cat cat", "dogs", "Dogs", "bus buses busess", "glass glas"]), "text", pairs=False))
    # equal spellings: byte order; a plural without its singular stays; "bus" and "buses" differ by more than an s,
    # "glass" ends in two, so nothing chains
    assert rows == {("Cat", "word"): (2, None), ("Dogs", "word"): (2, None), ("bus", "word"): (1, None), ("buses", "word"): (1, None),
                    ("busess", "word"): (1, None), ("glass", "word"): (1, None), ("glas", "word"): (1, None)}


def test_order_weight_and_limit(spark):
    df = ranking.word_ranking(frame(spark, ["yy yy yy xx xx xx zz"]), "text", pairs=False, top=2)
    assert [(r.term, r.n, r.weight) for r in df.orderBy("term").collect()] == [("xx", 3, 1.0), ("yy", 3, 1.0)]


def test_no_texts(spark):
    for texts in ([], [None], [""]):
        assert ranking.word_ranking(frame(spark, texts), "text").count() == 0
    # only one word appears at all: no pair of it can be told from chance
    assert got(ranking.word_ranking(frame(spark, ["ha ha ha ha"]), "text")) == {("ha", "word"): (4, None)}


def test_texts_are_scanned_once(spark):
    plan = ranking.spelling_counts(frame(spark, ["a b"]), "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1 and "Python" not in plan


def test_of_pairs_only_the_collocations_are_written(spark, monkeypatch):
    """Pairs are shuffled once under their stem; neither they nor their spellings are written whole."""
    kept = {}

    def park(df, name):
        kept[name] = df.cache()
        return df

    monkeypatch.setattr(ranking, "parked", park)
    texts = ["New York"] * 20 + ["a1 b1", "b1 c1", "c1 a1"] * 30 + ["new yorks"]
    rows = got(ranking.word_ranking(frame(spark, texts), "text", threshold=250.0, top=3))
    assert set(rows) >= {("b1", "word"), ("c1", "word")}
    for name, df in kept.items():
        stored = [v for r in df.collect() for v in r if isinstance(v, str) and " " in v]
        assert set(stored) <= {"new york"}, name
        df.unpersist()


def test_pairs_are_counted_by_stem_in_one_shuffle(spark):
    df = ranking.pair_counts(frame(spark, ["New York", "new yorks", "York new", None, "the York"]), "text")
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {(r.stem, r.n) for r in df.collect()} == {("new york", 2), ("york new", 1)}

"""Words and two-word collocations of a text column in one ranking.

Words are counted first, as they are spelled, in one partial aggregate.  Pairs of neighbouring
words (neither a stop word) are many, and most of them rare, so they are shuffled once, folded,
and then joined with the counts of their words; only collocations are written.  How pairs are spelled
is counted in a second reading of the texts, for those that can be shown:

* **One form per word.**  Spellings that differ in case are one word, shown in its most
  frequent spelling (ties: the first in byte order).  A word that ends in one ``s`` joins the same
  word without it where that occurs, and counts for it.  A singular never ends in ``s``, so no
  word is folded twice.  Pairs are folded in the same way, by their last letter.
* **Score.**  For a pair the likelihood ratio (``-2 ln``) of its words standing together
  independently against dependently, from four counts: pair, left word, right word, all words.
* **Ranking.**  Pairs above the threshold are collocations: they are ranked beside the words,
  and their counts are taken from those of their words.  Words left without a count go.

Pairs don't cross rows.  Words are counted per spelling before anything is joined, so a word
that stands in every text is one row a task; the joins' hot words are left to AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogprep.functions.text import ENGLISH_STOP_WORDS, tokens
from catalogprep.operators._common import parked

#: A word character followed by word characters or apostrophes.
SPELLED_WORD = r"[\p{L}\p{N}_][\p{L}\p{N}_']*"
COLLOCATION_THRESHOLD = 30.0
_FLOOR = 1e-10


def spelled_words(text_col: str) -> Column:
    """Words as they are spelled: a trailing ``'s`` is cut, numbers are dropped."""
    cut = F.transform(
        tokens(text_col, SPELLED_WORD, lower=False),
        lambda t: F.when(F.lower(t).endswith("'s"), F.substring(t, F.lit(1), F.length(t) - 2)).otherwise(t),
    )
    return F.filter(cut, lambda t: ~t.rlike(r"^\p{Nd}*$"))


def _words(df: DataFrame, text_col: str, stop_words) -> DataFrame:
    """``w``: the words of each text; stop words are empty, no other word is, and none holds a space."""
    stop = [w.lower() for w in stop_words]
    words = df.select(spelled_words(text_col).alias("w"))
    return words.select(F.transform("w", lambda t: F.when(F.lower(t).isin(stop), "").otherwise(t)).alias("w")) if stop else words


def _neighbours() -> Column:
    """The pairs of ``w``."""
    k = F.greatest(F.size("w") - 1, F.lit(0))
    return F.array_compact(F.zip_with(F.slice("w", 1, k), F.slice("w", 2, k),
                                      lambda a, b: F.when((a != "") & (b != ""), F.concat(a, F.lit(" "), b))))


def _spelled_pairs(df: DataFrame, text_col: str, stop_words) -> DataFrame:
    """``form``: every pair of neighbours, as it is spelled, as often as it occurs."""
    return _words(df, text_col, stop_words).select(F.explode(_neighbours()).alias("form"))


def spelling_counts(df: DataFrame, text_col: str, *, pairs: bool = True, stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """``(is_pair, form, n)``: how often every word and, with ``pairs``, every pair of
    neighbours occurs, stop words left out.  One scan, one aggregate."""
    forms = F.filter("w", lambda t: t != "")
    if pairs:
        forms = F.concat(forms, _neighbours())
    counts = _words(df, text_col, stop_words).select(F.explode(forms).alias("form")).groupBy("form").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.contains("form", F.lit(" ")).alias("is_pair"), "form", "n")


def pair_counts(df: DataFrame, text_col: str, *, plurals: bool = True, stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """``(stem, n)``: how often every pair occurs, whatever its spelling.  One scan, one aggregate."""
    stems = _spelled_pairs(df, text_col, stop_words).select(_stem(F.lower("form"), plurals).alias("stem"))
    return stems.groupBy("stem").agg(F.count(F.lit(1)).alias("n"))


def _plural(key: Column) -> Column:
    return key.endswith("s") & ~key.endswith("ss") & ~key.endswith(" s") & (F.length(key) > 1)


def _stem(key: Column, plurals: bool) -> Column:
    return F.when(_plural(key), F.substring(key, F.lit(1), F.length(key) - 1)).otherwise(key) if plurals else key


def fold_spellings(counts: DataFrame, *, plurals: bool = True) -> DataFrame:
    """``(is_pair, stem, n)`` from ``(is_pair, form, n)``: one row per word or pair, whatever its
    spelling, under its lower-cased form without a plural's ``s``.  A hash aggregate."""
    return counts.groupBy("is_pair", _stem(F.lower("form"), plurals).alias("stem")).agg(F.sum("n").alias("n"))


def spellings_to_show(counts: DataFrame, wanted: DataFrame, *, plurals: bool = True) -> DataFrame:
    """``(is_pair, stem, term)``: the spelling to show of the ``wanted`` (is_pair, stem) rows."""
    key = F.lower("form")
    plural = _plural(key) if plurals else F.lit(False)
    base = F.when(plural, F.substring("form", F.lit(1), F.length("form") - 1)).otherwise(F.col("form"))
    # the smallest (-n, spelling) is the most frequent spelling, ties by byte order
    first = lambda n, form: F.min(F.struct((-n).alias("m"), form.alias("form")))
    forms = counts.withColumns({"stem": _stem(key, plurals), "p": plural, "base": base}).join(wanted.select("is_pair", "stem"), ["is_pair", "stem"])
    by_base = forms.groupBy("is_pair", "stem", "base").agg(
        F.sum("n").alias("n"), F.count_if(~F.col("p")).alias("singular"), first(F.col("n"), F.when(F.col("p"), F.col("form"))).alias("as_is"))
    one = by_base.groupBy("is_pair", "stem").agg(
        F.sum("singular").alias("singular"), first(F.col("n"), F.col("base")).alias("one"), F.min("as_is").alias("as_is"))
    return one.select("is_pair", "stem", F.when(F.col("singular") > 0, F.col("one.form")).otherwise(F.col("as_is.form")).alias("term"))


def _log_likelihood(k: Column, n: Column, p: Column) -> Column:
    """``ln`` of a binomial likelihood, without its coefficient."""
    return F.log(F.greatest(p, F.lit(_FLOOR))) * k + F.log(F.greatest(1 - p, F.lit(_FLOOR))) * (n - k)


def likelihood_ratio(both: Column, left: Column, right: Column, total: Column) -> Column:
    """``-2 ln`` of the ratio of two likelihoods of the 2x2 table of a pair: the right word as
    frequent after the left one as elsewhere, or not.  0 where one word is all there is."""
    p = right / total
    after, elsewhere = F.try_divide(both, left), F.try_divide(right - both, total - left)
    score = -2 * (_log_likelihood(both, left, p) + _log_likelihood(right - both, total - left, p)
                  - _log_likelihood(both, left, after) - _log_likelihood(right - both, total - left, elsewhere))
    return F.when((total <= left) | (total <= right), F.lit(0.0)).otherwise(score)


def collocations(words: DataFrame, pairs: DataFrame, *, threshold: float = COLLOCATION_THRESHOLD, plurals: bool = True) -> DataFrame:
    """``(left, right, stem, n, score)`` of the ``pairs`` (stem, n) whose score is above
    ``threshold``; left and right are the stems of their words, whose counts ``words`` (stem, n) has."""
    total = words.agg(F.sum("n").cast("double")).scalar()
    left, right = (_stem(F.substring_index("stem", " ", i), plurals) for i in (1, -1))
    # of a pair, its stem alone goes through the joins
    scored = (pairs.join(words.select(F.col("stem").alias("word"), F.col("n").alias("n_left")), left == F.col("word")).drop("word")
              .join(words.select(F.col("stem").alias("word"), F.col("n").alias("n_right")), right == F.col("word")).drop("word"))
    score = likelihood_ratio(F.col("n").cast("double"), F.col("n_left").cast("double"), F.col("n_right").cast("double"), total)
    found = scored.select("stem", "n", score.alias("score")).where(F.col("score") > threshold)
    return found.select(left.alias("left"), right.alias("right"), "stem", "n", "score")


def word_ranking(
    df: DataFrame,
    text_col: str,
    *,
    top: int = 200,
    pairs: bool = True,
    threshold: float = COLLOCATION_THRESHOLD,
    plurals: bool = True,
    stop_words=ENGLISH_STOP_WORDS,
) -> DataFrame:
    """``(term, kind, n, score, weight)``: the ``top`` most frequent words and collocations
    (ties by term); weight is relative to the first, score is NULL for words.

    NULL texts have no words; an empty table gives no rows.  What several steps use, the counts
    of words, the collocations and the rows that can be shown, is written to the shared scratch folder.
    Spellings are settled for rows only that are as frequent as the last one shown."""
    spelled = parked(spelling_counts(df, text_col, pairs=False, stop_words=stop_words), "spellings")
    words = parked(fold_spellings(spelled, plurals=plurals).select("is_pair", "stem", "n"), "word-counts")
    none = F.lit(None).cast("double")
    ranked = words.withColumn("score", none)
    if pairs:
        counted = pair_counts(df, text_col, plurals=plurals, stop_words=stop_words)
        found = parked(collocations(words.select("stem", "n"), counted, threshold=threshold, plurals=plurals), "collocations")
        taken = found.select(F.explode(F.array("left", "right")).alias("stem"), "n").groupBy("stem").agg(F.sum("n").alias("taken"))
        left = F.col("n") - F.coalesce("taken", F.lit(0))
        kept = parked(words.join(taken, "stem", "left").select("is_pair", "stem", left.alias("n")).where("n > 0"), "words-left")
        ranked = kept.withColumn("score", none).unionByName(found.select(F.lit(True).alias("is_pair"), "stem", "n", "score"))
    last = ranked.orderBy(F.desc("n")).limit(top).agg(F.min("n")).scalar()
    likely = parked(ranked.where(F.col("n") >= last), "likely")
    shown = spellings_to_show(spelled, likely, plurals=plurals)
    if pairs:
        wanted = likely.where("is_pair").select("stem")
        forms = (_spelled_pairs(df, text_col, stop_words).withColumn("stem", _stem(F.lower("form"), plurals)).join(wanted, "stem", "left_semi")
                 .groupBy("form").agg(F.count(F.lit(1)).alias("n")).select(F.lit(True).alias("is_pair"), "form", "n"))
        shown = shown.unionByName(spellings_to_show(forms, likely, plurals=plurals))
    named = likely.join(shown, ["is_pair", "stem"])
    best = named.select("term", F.when(F.col("is_pair"), "pair").otherwise("word").alias("kind"), "n", "score").orderBy(
        F.desc("n"), F.asc("term")).limit(top)
    # at most ``top`` rows from here on
    return best.withColumn("weight", F.col("n") / F.max("n").over(Window.partitionBy()))

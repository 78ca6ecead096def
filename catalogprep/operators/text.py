"""Term frequencies behind word clouds, computed over whole texts.

Tokens: lower-cased word-cloud tokens (a word character then word characters
or apostrophes), a trailing ``'s`` removed, all-digit tokens dropped, stop
words dropped.  Bigrams are neighbouring token pairs in which neither word is
a stop word (the collocation candidates).  Counting is a partial aggregate
per term; only the top ``n`` rows are kept (``TakeOrderedAndProject``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogprep.functions.text import CLOUD_TOKEN, ENGLISH_STOP_WORDS, adjacent_pairs, tokens


def cloud_tokens(text_col: str) -> Column:
    """Word-cloud tokens before stop-word removal (trailing ``'s`` cut with
    plain string functions, not a regex per token)."""
    toks = F.transform(
        tokens(text_col, CLOUD_TOKEN),
        lambda t: F.when(t.endswith("'s"), F.substring(t, F.lit(1), F.length(t) - 2)).otherwise(t),
    )
    return F.filter(toks, lambda t: ~t.rlike(r"^\p{Nd}+$"))


def _top(counts: DataFrame, key: str, n: int) -> DataFrame:
    top = counts.orderBy(F.desc("n"), F.asc(key)).limit(n)
    # weight relative to the most frequent entry (window over <= n rows)
    return top.withColumn("weight", F.col("n") / F.max("n").over(Window.partitionBy()))


def term_freq(df: DataFrame, text_col: str, *, top: int = 200, stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """``(term, n, weight)`` for the ``top`` most frequent terms."""
    stop = list(stop_words)
    toks = F.filter(cloud_tokens(text_col), lambda t: ~t.isin(stop))
    counts = df.select(F.explode(toks).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n")
    )
    return _top(counts, "term", top)


def bigram_freq(df: DataFrame, text_col: str, *, top: int = 200, stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """``(bigram, n, weight)`` for the ``top`` most frequent word pairs."""
    # tokens projected once: the pair expression refers to them three times
    df = df.select(cloud_tokens(text_col).alias("_toks"))
    kept = adjacent_pairs(F.col("_toks"), stop_words=stop_words)
    counts = df.select(F.explode(kept).alias("bigram")).groupBy("bigram").agg(F.count(F.lit(1)).alias("n"))
    return _top(counts, "bigram", top)

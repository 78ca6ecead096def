"""Text helpers: tokenisation, stop words, n-grams (built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogprep.functions._util import col_of

#: Tokens of two or more word characters.  Spark's ``\w`` is ASCII-only, so
#: letters/digits are spelled out as Unicode classes.
WORD_TOKEN = r"[\p{L}\p{N}_]{2,}"

#: Word-cloud style tokens: a word character followed by word characters or
#: apostrophes.
CLOUD_TOKEN = r"[\p{L}\p{N}_][\p{L}\p{N}_']+"

# Spark's default English stop-word list
# (``StopWordsRemover.loadDefaultStopWords("english")``, 181 words, in its
# order); a test checks it still equals the list shipped with Spark.
ENGLISH_STOP_WORDS: tuple[str, ...] = (
    'i', 'me', 'my', 'myself', 'we', 'our', 'ours', 'ourselves', 'you', 'your', 'yours',
    'yourself', 'yourselves', 'he', 'him', 'his', 'himself', 'she', 'her', 'hers',
    'herself', 'it', 'its', 'itself', 'they', 'them', 'their', 'theirs', 'themselves',
    'what', 'which', 'who', 'whom', 'this', 'that', 'these', 'those', 'am', 'is', 'are',
    'was', 'were', 'be', 'been', 'being', 'have', 'has', 'had', 'having', 'do', 'does',
    'did', 'doing', 'a', 'an', 'the', 'and', 'but', 'if', 'or', 'because', 'as',
    'until', 'while', 'of', 'at', 'by', 'for', 'with', 'about', 'against', 'between',
    'into', 'through', 'during', 'before', 'after', 'above', 'below', 'to', 'from',
    'up', 'down', 'in', 'out', 'on', 'off', 'over', 'under', 'again', 'further', 'then',
    'once', 'here', 'there', 'when', 'where', 'why', 'how', 'all', 'any', 'both',
    'each', 'few', 'more', 'most', 'other', 'some', 'such', 'no', 'nor', 'not', 'only',
    'own', 'same', 'so', 'than', 'too', 'very', 's', 't', 'can', 'will', 'just', 'don',
    'should', 'now', "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd",
    "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's",
    "it's", "we're", "they're", "i've", "we've", "you've", "they've", "isn't", "aren't",
    "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't",
    "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't",
    'cannot', 'could', "here's", "how's", "let's", 'ought', "that's", "there's",
    "what's", "when's", "where's", "who's", "why's", 'would',
)


def tokens(c: str | Column, pattern: str = WORD_TOKEN, *, lower: bool = True) -> Column:
    """All matches of ``pattern`` in the (lower-cased) text, in order."""
    src = col_of(c)
    return F.regexp_extract_all(F.lower(src) if lower else src, F.lit(pattern), 0)


def drop_stop_words(toks: Column, stop_words=ENGLISH_STOP_WORDS) -> Column:
    """Remove stop words; the literal list becomes a hash-set lookup."""
    if not stop_words:
        return toks
    return F.filter(toks, lambda t: ~t.isin(list(stop_words)))


def adjacent_pairs(toks: Column, sep: str = " ", stop_words=()) -> Column:
    """Bigrams of neighbouring tokens (empty for fewer than two tokens); pairs
    with a stop word are left out."""
    stop = list(stop_words)
    k = F.greatest(F.size(toks) - 1, F.lit(0))

    def pair(a: Column, b: Column) -> Column:
        both = F.concat(a, F.lit(sep), b)
        return F.when(~a.isin(stop) & ~b.isin(stop), both) if stop else both

    return F.array_compact(F.zip_with(F.slice(toks, 1, k), F.slice(toks, 2, k), pair))

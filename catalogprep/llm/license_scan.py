"""License scans by a positional rare-token index, in DataFrame functions only.

Every licence template has mandatory key phrases, placed relative to the first of them,
and context words around them.  One pass over all documents counts in how many of them
each template word stands; the words of a key phrase with the highest inverse document
frequency form the index: word -> (template, place).  A second pass takes each file's
occurrences of indexed words, turns every posting into the start that it implies,
intersects a template's postings on equal starts, and verifies the key phrases there.
A key phrase can only stand where its rarest words stand, so no place is missed.
A place counts if its key phrases hold, whatever the other files say.
The score of a place is the share of its template's IDF weight found at its relative
places; a file's score is its best verified one.

Both passes are narrow (no row is shuffled, only word counts of the template vocabulary
are); the driver sees one count per template word.

Defined results: null and empty texts have no words, empty labels, null first and last
word, and score 0; repeated rows are scanned each for itself; an empty table gives an
empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogprep.llm._common import LETTERED, ascii_lower, read_table, text_of, words

# Label, key phrases with their place relative to the first, words of the
# usual wording with their relative places (key phrases first).
BASE_TEMPLATES = (
    ("cc-by", ((0, "cc by"),), ()),
    ("gpl", ((0, "general public license"),), ()),
    ("reserved", ((0, "all rights reserved"),), ()),
)
MORE_TEMPLATES = (
    ("agpl", ((0, "affero general public license"),), ((-1, "gnu"),)),
    ("apache-2.0", ((0, "apache license version 2 0"),), ((-3, "licensed under the"),)),
    ("bsd", ((0, "redistribution and use in source and binary forms"),), ((8, "with or without modification"),)),
    ("cc-by-nc", ((0, "cc by nc"),), ((-2, "licensed under"),)),
    ("cc-by-nd", ((0, "cc by nd"),), ((-2, "licensed under"),)),
    ("cc-by-sa", ((0, "cc by sa"),), ((-2, "licensed under"),)),
    ("cc0", ((0, "cc0 1 0"),), ((3, "universal"),)),
    ("gpl-2", ((0, "general public license"), (3, "version 2")), ((-2, "the gnu"),)),
    ("gpl-3", ((0, "general public license"), (3, "version 3")), ((-2, "the gnu"),)),
    ("isc", ((0, "permission to use copy modify and or distribute this software"),), ((9, "for any purpose"),)),
    ("lgpl", ((0, "lesser general public license"),), ((-1, "gnu"),)),
    ("mit", ((0, "permission is hereby granted"), (4, "free of charge")), ((7, "to any person obtaining a copy"),)),
    ("mpl-2.0", ((0, "mozilla public license"),), ((3, "version 2 0"),)),
    ("unlicense", ((0, "free and unencumbered software"),), ((4, "released into the public domain"),)),
)
RARE_WORDS = 3


class Template:
    """A licence template with its indexed words."""

    def __init__(self, label: str, keys, context):
        self.label = label
        self.keys = [(at, phrase.split()) for at, phrase in keys]
        self.placed = [(at + i, w) for at, p in self.keys for i, w in enumerate(p)]
        self.mandatory = list(self.placed)
        self.placed += [(at + i, w) for at, phrase in context for i, w in enumerate(phrase.split())]

    def rare(self, idf: dict[str, float], n: int) -> list[tuple[int, str]]:
        """The up to ``n`` rarest words of the key phrases; words with less than half the
        weight of the rarest are left out, as their postings are long and say little."""
        best = sorted(self.mandatory, key=lambda p: (-idf[p[1]], p[0]))
        return [p for p in best if idf[p[1]] >= idf[best[0][1]] / 2][:n]


def template_idf(doc_words: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """IDF of the template words over all documents (column ``words``)."""
    hit = F.array_intersect("words", F.array(*map(F.lit, vocabulary)))
    # the empty word counts the documents
    rows = (doc_words.select(F.explode(F.concat(F.array(F.lit("")), hit)).alias("w"))
            .groupBy("w").agg(F.count("*").alias("n")).collect())  # at most one row per template word
    df = {r.w: r.n for r in rows}
    return {w: 1.0 + math.log((1.0 + df.get("", 0)) / (1.0 + df.get(w, 0))) for w in vocabulary}


def _starts(t: Template, rare: list[tuple[int, str]]) -> Column:
    """Starts on which all indexed words of the template agree and whose key phrases hold."""
    def postings(at: int, w: str) -> Column:
        return F.transform(F.filter("hits", lambda h: h.w == w), lambda h: h.i - at)

    found = postings(*rare[0])
    for at, w in rare[1:]:
        found = F.array_intersect(found, postings(at, w))

    def holds(s: Column) -> Column:
        ok = s >= 0
        for at, phrase in t.keys:
            ok = ok & (F.slice("words", F.greatest(s, F.lit(0)) + at + 1, len(phrase)) == F.array(*map(F.lit, phrase)))
        return ok

    return F.filter(found, holds)


def _share(t: Template, idf: dict[str, float], s: Column) -> Column:
    total = sum(idf[w] for _, w in t.placed)
    got = F.lit(0.0)
    for at, w in t.placed:
        got = got + F.when(F.get("words", s + at) == w, idf[w]).otherwise(0.0)
    return F.least(F.lit(1.0), got / total)


def scan(docs: DataFrame, base=BASE_TEMPLATES, more=MORE_TEMPLATES,
         rare_words: int = RARE_WORDS) -> DataFrame:
    """doc_id, n_words, places (label, word, share of every verified place, base and
    other), n_base, first_word, last_word, base_labels, labels, score."""
    first = [Template(*t) for t in base]
    rest = [Template(*t) for t in more]
    tokens = docs.select("doc_id", words(ascii_lower(text_of()), LETTERED).alias("words"))
    idf = template_idf(tokens, sorted({w for t in first + rest for _, w in t.placed}))
    rare = {t.label: t.rare(idf, rare_words) for t in first + rest}
    index = sorted({w for places in rare.values() for _, w in places})
    hits = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("i"), w.alias("w"))), lambda h: h.w.isin(index))
    scanned = tokens.withColumn("hits", hits)

    def places(t: Template) -> Column:
        return F.transform(_starts(t, rare[t.label]), lambda s: F.struct(
            F.lit(t.label).alias("label"), s.cast("bigint").alias("word"), _share(t, idf, s).alias("share")))

    none = F.from_json(F.lit("[]"), "array<struct<label:string,word:bigint,share:double>>")

    def all_of(ts: list[Template]) -> Column:
        found = F.concat(none, *(places(t) for t in ts))
        return F.when(F.size("hits") > 0, found).otherwise(none)  # most files have no indexed word

    out = scanned.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"), all_of(first).alias("base_places"),
        all_of(rest).alias("more_places"))
    joined = lambda c: F.array_join(F.sort_array(F.array_distinct(F.transform(c, lambda p: p.label))), ",")
    both = F.concat("base_places", "more_places")
    starts = F.transform("base_places", lambda p: p.word)
    return out.select(
        "doc_id", "n_words", F.size("base_places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined("base_places").alias("base_labels"), joined(both).alias("labels"),
        F.coalesce(F.array_max(F.transform(both, lambda p: p.share)), F.lit(0.0)).alias("score"),
        both.alias("places"))


def query(spark, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents")).drop("places").withColumn("score", F.round("score", 9))


def _values(base=BASE_TEMPLATES, more=MORE_TEMPLATES) -> str:
    """The templates as SQL rows: label, whether base, place, word, whether mandatory."""
    rows = []
    for kind, templates in ((True, base), (False, more)):
        for t in (Template(*x) for x in templates):
            rows += [f"('{t.label}', {kind}, {at}, '{w}', {nth < len(t.mandatory)})" for nth, (at, w) in enumerate(t.placed)]
    return ", ".join(rows)


#: Every template at every place where all words of its key phrases stand.
ORACLE = rf"""
WITH tpl(label, base, off, word, must) AS (VALUES {_values()}),
d AS (
  SELECT row_number() OVER () AS u, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
x AS (SELECT u, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM d),
hits AS (SELECT * FROM x WHERE word IN (SELECT word FROM tpl)),
idf AS (
  SELECT t.word, 1 + ln((1.0::DOUBLE + (SELECT count(*) FROM d)) / (1.0::DOUBLE + count(DISTINCT h.u))) AS idf
  FROM (SELECT DISTINCT word FROM tpl) t LEFT JOIN hits h USING (word) GROUP BY 1),
need AS (SELECT label, count(DISTINCT off) AS n FROM tpl WHERE must GROUP BY 1),
place AS (
  SELECT u, label, base, pos - off AS s FROM hits JOIN tpl USING (word) JOIN need USING (label) WHERE must AND pos >= off
  GROUP BY ALL HAVING count(DISTINCT off) = any_value(need.n)),
whole AS (SELECT label, sum(idf) AS total FROM tpl JOIN idf USING (word) GROUP BY 1),
share AS (
  SELECT p.u, p.label, p.base, p.s, least(1, sum(CASE WHEN h.u IS NOT NULL THEN idf ELSE 0 END) / any_value(total)) AS share
  FROM place p JOIN tpl t USING (label) JOIN idf USING (word) JOIN whole USING (label)
  LEFT JOIN hits h ON h.u = p.u AND h.pos = p.s + t.off AND h.word = t.word GROUP BY ALL),
f AS (
  SELECT u, count(*) FILTER (WHERE base) AS n_base, min(s) FILTER (WHERE base) AS first_word, max(s) FILTER (WHERE base) AS last_word,
         coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM share GROUP BY u)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, round(coalesce(score, 0), 9) AS score
FROM d LEFT JOIN f USING (u)
"""

"""Queries: term and bigram frequencies over whole document texts, JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogprep.functions.text import tokens
from catalogprep.operators import text as TX
from catalogprep.operators.heavy import top_n_by_summary
from catalogprep.operators.ranking import word_ranking
from catalogprep.operators._common import spread
from catalogprep.plans.q_features import STOP_SQL
from catalogprep.plans.registry import register
from catalogprep.sources.readers import read_table

TOKS_SQL = """toks AS (
  SELECT doc_id, list_filter(
           list_transform(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_][\\p{L}\\p{N}_'']+'),
                          lambda x: regexp_replace(x, '''s$', '')),
           lambda x: NOT regexp_full_match(x, '\\p{Nd}+')) AS t
  FROM documents)"""


@register(
    "term_freq",
    f"""WITH {TOKS_SQL},
c AS (SELECT term, count(*) AS n FROM (SELECT unnest(t) AS term FROM toks) WHERE NOT list_contains({STOP_SQL}, term)
      GROUP BY 1 ORDER BY n DESC, term LIMIT 200)
SELECT term, n, n / max(n) OVER () AS weight FROM c""",
)
def term_freq(spark, d):
    return TX.term_freq(spread(read_table(spark, d, "documents").select("text")), "text")


@register(
    "bigram_freq",
    f"""WITH {TOKS_SQL},
p AS (SELECT unnest(list_transform(range(1, len(t)), lambda i:
        CASE WHEN NOT list_contains({STOP_SQL}, t[i]) AND NOT list_contains({STOP_SQL}, t[i + 1])
             THEN t[i] || ' ' || t[i + 1] END)) AS bigram FROM toks),
c AS (SELECT bigram, count(*) AS n FROM p WHERE bigram IS NOT NULL GROUP BY 1 ORDER BY n DESC, bigram LIMIT 200)
SELECT bigram, n, n / max(n) OVER () AS weight FROM c""",
)
def bigram_freq(spark, d):
    return TX.bigram_freq(spread(read_table(spark, d, "documents").select("text")), "text")


# forms as spelled; words and pairs folded by case and final s; best spelling by count, then bytes
FOLD_SQL = f"""sp AS (
  SELECT list_filter(
           list_transform(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_][\\p{{L}}\\p{{N}}_'']*'),
                          lambda x: CASE WHEN lower(x) LIKE '%''s' THEN x[:length(x) - 2] ELSE x END),
           lambda x: NOT regexp_full_match(x, '\\p{{Nd}}*')) AS t
  FROM documents),
ok AS (SELECT t, list_transform(t, lambda x: NOT list_contains({STOP_SQL}, lower(x))) AS k FROM sp),
forms AS (
  SELECT is_pair, form, count(*) AS n FROM (
    SELECT false AS is_pair, unnest(list_transform(list_filter(range(1, len(t) + 1), lambda i: k[i]), lambda i: t[i])) AS form FROM ok
    UNION ALL
    SELECT true, unnest(list_transform(list_filter(range(1, len(t)), lambda i: k[i] AND k[i + 1]), lambda i: t[i] || ' ' || t[i + 1])) FROM ok)
  GROUP BY ALL),
keyed AS (SELECT *, lower(form) AS key, lower(form) LIKE '%s' AND lower(form) NOT LIKE '%ss' AND length(form) > 1 AS plural FROM forms),
based AS (
  SELECT *, CASE WHEN plural THEN key[:length(key) - 1] ELSE key END AS stem,
         CASE WHEN plural THEN form[:length(form) - 1] ELSE form END AS base FROM keyed),
spelled AS (
  SELECT b.is_pair, b.stem, CASE WHEN s.stem IS NULL THEN form ELSE base END AS shown, sum(n) AS n
  FROM based b LEFT JOIN (SELECT DISTINCT is_pair, stem FROM based WHERE NOT plural) s ON s.is_pair = b.is_pair AND s.stem = b.stem
  GROUP BY ALL),
folded AS (SELECT is_pair, stem, first(shown ORDER BY n DESC, shown) AS term, sum(n) AS n FROM spelled GROUP BY ALL)"""


def _ranked_sql(rows: str) -> str:
    return f"""WITH {FOLD_SQL},
{rows},
best AS (SELECT * FROM ranked ORDER BY n DESC, term LIMIT 200)
SELECT term, kind, CAST(n AS BIGINT) AS n, round(score, 4) AS score, n / max(n) OVER () AS weight FROM best"""


_L = "(ln(greatest({p}, 1e-10::DOUBLE)) * {k} + ln(greatest(1 - {p}, 1e-10::DOUBLE)) * ({n} - {k}))"
_SCORE_SQL = "-2 * (" + " ".join([
    _L.format(k="c", n="a", p="(b / t)"), "+", _L.format(k="(b - c)", n="(t - a)", p="(b / t)"),
    "-", _L.format(k="c", n="a", p="(c / a)"), "-", _L.format(k="(b - c)", n="(t - a)", p="((b - c) / (t - a))")]) + ")"


@register(
    "word_ranking",
    _ranked_sql(f"""stems AS (
  SELECT term, n, CASE WHEN w LIKE '%s' AND w NOT LIKE '%ss' AND length(w) > 1 THEN w[:length(w) - 1] ELSE w END AS l,
         CASE WHEN v LIKE '%s' AND v NOT LIKE '%ss' AND length(v) > 1 THEN v[:length(v) - 1] ELSE v END AS r
  FROM (SELECT term, n, lower(split_part(term, ' ', 1)) AS w, lower(split_part(term, ' ', 2)) AS v FROM folded WHERE is_pair)),
four AS (
  SELECT s.term, s.n, l, r, s.n::DOUBLE AS c, x.n::DOUBLE AS a, y.n::DOUBLE AS b,
         (SELECT sum(n) FROM folded WHERE NOT is_pair)::DOUBLE AS t
  FROM stems s JOIN folded x ON NOT x.is_pair AND x.stem = l JOIN folded y ON NOT y.is_pair AND y.stem = r),
pairs AS (SELECT * FROM (SELECT term, n, l, r, CASE WHEN t <= a OR t <= b THEN 0 ELSE {_SCORE_SQL} END AS score FROM four) WHERE score > 30),
taken AS (SELECT stem, sum(n) AS n FROM (SELECT l AS stem, n FROM pairs UNION ALL SELECT r, n FROM pairs) GROUP BY 1),
ranked AS (
  SELECT * FROM (SELECT f.term, 'word' AS kind, f.n - coalesce(k.n, 0) AS n, NULL::DOUBLE AS score
                 FROM folded f LEFT JOIN taken k ON k.stem = f.stem WHERE NOT f.is_pair) WHERE n > 0
  UNION ALL SELECT term, 'pair', n, score FROM pairs)"""),
)
def ranking(spark, d):
    docs = spread(read_table(spark, d, "documents").select("text"))
    return word_ranking(docs, "text").withColumn("score", F.round("score", 4))


@register(
    "word_ranking_singles",
    _ranked_sql("ranked AS (SELECT term, 'word' AS kind, n, NULL::DOUBLE AS score FROM folded WHERE NOT is_pair)"),
)
def ranking_singles(spark, d):
    docs = spread(read_table(spark, d, "documents").select("text"))
    return word_ranking(docs, "text", pairs=False).withColumn("score", F.round("score", 4))


@register(
    "topn_words_summary",
    """WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM documents),
c AS (SELECT term, count(*) AS n FROM w GROUP BY 1 ORDER BY n DESC, term LIMIT 20)
SELECT term, n, CAST(row_number() OVER (ORDER BY n DESC, term) AS INTEGER) AS rank FROM c""",
)
def topn_words_summary(spark, d):
    docs = spread(read_table(spark, d, "documents").select("text"))
    return top_n_by_summary(docs.select(F.explode(tokens("text")).alias("term")), "term", 20)


@register(
    "topn_words_per_language_summary",
    """WITH w AS (SELECT lang, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM documents),
c AS (SELECT lang, term, count(*) AS n FROM w WHERE lang IS NOT NULL GROUP BY 1, 2)
SELECT lang, term, n, CAST(row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS INTEGER) AS rank FROM c
QUALIFY rank <= 5""",
)
def topn_words_per_language_summary(spark, d):
    docs = spread(read_table(spark, d, "documents").select("lang", "text"))
    return top_n_by_summary(docs.select("lang", F.explode(tokens("text")).alias("term")), "term", 5, groups=["lang"])


@register(
    "topn_flat_summary",
    """SELECT l_partkey, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, l_partkey) AS INTEGER) AS rank
FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 10""",
)
def topn_flat_summary(spark, d):
    # no part is frequent: the certificate fails and all keys are counted
    return top_n_by_summary(read_table(spark, d, "lineitem"), "l_partkey", 10, tracked=100)


@register(
    "json_props",
    "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def json_props(spark, d):
    e = read_table(spark, d, "events")
    return e.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@register(
    "json_map_rows",
    """SELECT event_id, key, TRY_CAST(json_extract_string(props, '$."' || key || '"') AS INTEGER) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)""",
)
def json_map_rows(spark, d):
    e = read_table(spark, d, "events")
    m = F.from_json("props", "map<string,int>")
    return e.select("event_id", F.explode(m).alias("key", "value"))

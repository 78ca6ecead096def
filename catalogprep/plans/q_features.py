"""Queries: one-hot, multi-hot, scaling, TF-IDF, the feature matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogprep.functions.text import ENGLISH_STOP_WORDS
from catalogprep.operators import features as FE
from catalogprep.operators import fitted
from catalogprep.operators._common import bounded_domain, spread
from catalogprep.operators.multivalue import member_list
from catalogprep.plans import oracle_sql as S
from catalogprep.plans import standins
from catalogprep.plans.catalog_job import clean_titles
from catalogprep.plans.q_catalog import JOB_SQL, KEEP_ALL_SQL, SPLIT_SQL
from catalogprep.plans.registry import register
from catalogprep.session import scratch_path
from catalogprep.sources.readers import read_table

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
NATIONS = [f"NATION_{i}" for i in range(25)]


@register(
    "one_hot",
    "SELECT event_id, value, "
    + ", ".join(f"CASE WHEN event_type = '{v}' THEN 1 ELSE 0 END AS event_type_{v}" for v in EVENT_TYPES)
    + " FROM events",
)
def one_hot(spark, d):
    e = read_table(spark, d, "events").select("event_id", "value", "event_type")
    return FE.one_hot(e, "event_type")


@register(
    "multi_hot",
    S.with_(S.LISTS, "arrs AS (SELECT o_orderkey, regexp_split_to_array(country, ',\\s*') AS arr FROM lists)")
    + "SELECT o_orderkey, "
    + ", ".join(f"CAST(coalesce(list_contains(arr, '{n}'), false) AS INTEGER) AS countries_{n}" for n in NATIONS)
    + " FROM arrs",
)
def multi_hot(spark, d):
    lists = standins.order_country_lists(spark, d).select("o_orderkey", member_list("country").alias("countries"))
    # the label universe is the nation dimension (bounded), not the labels seen
    labels = bounded_domain(read_table(spark, d, "nation"), "n_name")
    return FE.multi_hot(lists, "countries", values=labels)


SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@register(
    "standard_scale",
    "WITH fit AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALE_COLS)
    + " FROM lineitem)\nSELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1.0::DOUBLE END, 6) AS {c}" for c in SCALE_COLS)
    + " FROM lineitem CROSS JOIN fit",
)
def standard_scale(spark, d):
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *SCALE_COLS)
    out = FE.standard_scale(li, SCALE_COLS)
    return out.withColumns({c: F.round(c, 6) for c in SCALE_COLS})


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STOP_SQL = _sql_list(ENGLISH_STOP_WORDS)

TFIDF_SQL = f"""WITH toks AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM documents),
f AS (SELECT * FROM toks WHERE NOT list_contains({STOP_SQL}, term)),
tf AS (SELECT doc_id, term, count(*) AS tf FROM f GROUP BY 1, 2),
terms AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY 1 ORDER BY total DESC, term LIMIT 5000),
n AS (SELECT count(*) AS n FROM documents),
w AS (SELECT tf.doc_id, tf.term, tf.tf * (ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0::DOUBLE) AS raw
      FROM tf JOIN terms ON tf.term = terms.term CROSS JOIN n)
SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM w"""


@register("tfidf", TFIDF_SQL)
def tfidf(spark, d):
    # thin scan spread by id: term counts and the per-document norm reuse it
    docs = spread(read_table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    return FE.tfidf(docs, "doc_id", "text").withColumn("weight", F.round("weight", 6))


@register(
    "tfidf_corpus_stop_words",
    TFIDF_SQL.replace(f"""f AS (SELECT * FROM toks WHERE NOT list_contains({STOP_SQL}, term)),""", """stop AS (
  SELECT term FROM (SELECT DISTINCT doc_id, term FROM toks) GROUP BY 1 HAVING count(*) > 0.1 * (SELECT count(*) FROM documents)),
f AS (SELECT * FROM toks WHERE term NOT IN (SELECT term FROM stop)),"""),
)
def tfidf_corpus_stop_words(spark, d):
    """TF-IDF with another list of stop words: those of the corpus itself."""
    docs = spread(read_table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    stop = FE.frequent_terms(docs, "doc_id", "text", 0.1)
    return FE.tfidf(docs, "doc_id", "text", stop_words=stop).withColumn("weight", F.round("weight", 6))


LANGS = ["de", "en", "es", "fr"]
SOURCES = [f"src{i}" for i in range(20)]

FEATURE_SQL = TFIDF_SQL.replace(
    "SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM w",
    """, weights AS (SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM w),
idx AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx FROM terms),
sparse AS (
  SELECT doc_id, string_agg(CAST(idx AS VARCHAR) || ':' || CAST(CAST(weight AS DECIMAL(10,6)) AS VARCHAR), ' ' ORDER BY idx) AS tfidf
  FROM weights JOIN idx ON weights.term = idx.term GROUP BY doc_id),
fit AS (SELECT avg(CAST(n_chars AS DOUBLE)) AS m, stddev_pop(CAST(n_chars AS DOUBLE)) AS s FROM documents)
SELECT d.doc_id, """
    + ", ".join(f"CASE WHEN d.lang = '{v}' THEN 1 ELSE 0 END AS lang_{v}" for v in LANGS) + ", "
    + ", ".join(f"CASE WHEN d.source = '{v}' THEN 1 ELSE 0 END AS source_{v}" for v in SOURCES)
    + """, round((CAST(d.n_chars AS DOUBLE) - m) / CASE WHEN s > 0 THEN s ELSE 1.0::DOUBLE END, 6) AS n_chars,
       l.quality, l.toxic, sp.tfidf
FROM documents d CROSS JOIN fit LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN sparse sp ON sp.doc_id = d.doc_id""",
)


@register("feature_matrix", FEATURE_SQL)
def feature_matrix(spark, d):
    """Documents as one feature row each; the sparse TF-IDF row is rendered
    as ``idx:weight`` text (weights to 6 dp) for the oracle comparison."""
    docs = spread(read_table(spark, d, "documents"), "doc_id")
    feats = FE.document_features(docs, read_table(spark, d, "labels"))
    return feats.select(
        *[c for c in feats.columns if c not in ("n_chars", "tfidf_idx", "tfidf_val")],
        F.round("n_chars", 6).alias("n_chars"),
        _sparse_as_text().alias("tfidf"),
    )


def _sparse_as_text():
    pairs = F.transform(
        F.arrays_zip("tfidf_idx", "tfidf_val"),
        lambda z: F.concat(z["tfidf_idx"].cast("string"), F.lit(":"),
                           F.round(z["tfidf_val"], 6).cast("decimal(10,6)").cast("string")),
    )
    return F.array_join(pairs, " ")


@register(
    "one_hot_long",
    "SELECT event_id, 'event_type_' || event_type AS feature, CAST(1 AS INTEGER) AS value FROM events WHERE event_type IS NOT NULL",
)
def one_hot_long(spark, d):
    return FE.one_hot_long(read_table(spark, d, "events"), "event_id", "event_type")


@register(
    "multi_hot_long",
    S.with_(S.LISTS, "arrs AS (SELECT o_orderkey, list_distinct(regexp_split_to_array(country, ',\\s*')) AS arr FROM lists)")
    + "SELECT o_orderkey, 'countries_' || unnest(arr) AS feature, CAST(1 AS INTEGER) AS value FROM arrs",
)
def multi_hot_long(spark, d):
    lists = standins.order_country_lists(spark, d).select("o_orderkey", member_list("country").alias("countries"))
    return FE.multi_hot_long(lists, "o_orderkey", "countries")


CATEGORIES = {
    "type": ["Movie", "TV Show"],
    "rating": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "movie_type": ["Global", "Local"],
    "show_type": ["Global", "Local"],
}
LABELS = {
    "genres": ["Comedies", "Docuseries", "Dramas", "Independent", "International"],
    "released_countries": [*NATIONS, "Unknown"],
    "released_languages": ["lang_africa", "lang_america", "lang_asia", "lang_europe", "lang_extra", "lang_middle east"],
}
NUMBERS = ("movie_duration", "seasons", "release_year")


def _title_features_sql() -> str:
    # the steps up to the typed titles are those of the cleaning job
    head = JOB_SQL[:JOB_SQL.index("exploded AS")].rstrip().rstrip(",")
    text = TFIDF_SQL[len("WITH "):TFIDF_SQL.index("SELECT doc_id, term, round(")].rstrip()
    text = text.replace("doc_id", "show_id").replace("lower(text)", "lower(description)").replace("FROM documents", "FROM clean")
    clean = """clean AS (
  SELECT s.show_id, s.type, s.rating, s.movie_type, s.show_type, s.genres, s.added_date, s.description,
         p.cl AS released_countries, p.langs AS released_languages,
         CAST(CASE WHEN type = 'Movie' THEN TRY_CAST(regexp_replace(duration, ' min', '', 'g') AS INTEGER) END AS DOUBLE) AS movie_duration,
         CAST(CASE WHEN type = 'TV Show' THEN TRY_CAST(regexp_replace(duration, '\\D', '', 'g') AS INTEGER) END AS DOUBLE) AS seasons,
         CAST(TRY_CAST(release_year AS INTEGER) AS DOUBLE) AS release_year
  FROM shaped s JOIN per p ON p.show_id = s.show_id)"""
    sparse = """idx AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx FROM terms),
weights AS (SELECT show_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY show_id)), 6) AS weight FROM w),
sparse AS (
  SELECT show_id, string_agg(CAST(idx AS VARCHAR) || ':' || CAST(CAST(weight AS DECIMAL(10,6)) AS VARCHAR), ' ' ORDER BY idx) AS tfidf
  FROM weights JOIN idx ON weights.term = idx.term GROUP BY show_id),
fit AS (SELECT """ + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMBERS) + " FROM clean)"
    one = [f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, vs in CATEGORIES.items() for v in vs]
    many = [f"CAST(coalesce(list_contains({c}, '{v}'), false) AS INTEGER) AS \"{c}_{v}\"" for c, vs in LABELS.items() for v in vs]
    scaled = [f"round(({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1.0::DOUBLE END, 6) AS {c}" for c in NUMBERS]
    days = ["CAST(year(added_date) AS INTEGER) AS added_year", "CAST(month(added_date) AS INTEGER) AS added_month",
            "CAST(day(added_date) AS INTEGER) AS added_day", "CAST(isodow(added_date) - 1 AS INTEGER) AS added_dayofweek"]
    return (S.with_(S.TITLES, S.VALID, S.LANG_MAP, SPLIT_SQL, KEEP_ALL_SQL, head, clean, text, sparse)
            + "SELECT c.show_id, " + ", ".join([*one, *many, *scaled, *days])
            + ", sp.tfidf FROM clean c CROSS JOIN fit LEFT JOIN sparse sp ON sp.show_id = c.show_id")


@register("title_features", _title_features_sql())
def title_features(spark, d):
    """Clean titles (one row each) to features: the whole chain, keyed by show_id."""
    titles = clean_titles(
        standins.titles_from_orders(spark, d), standins.valid_nations(spark, d), standins.nation_languages(spark, d),
        mode="keep_all",
    ).titles
    feats = FE.title_features(titles, categorical=CATEGORIES, lists=LABELS)
    return feats.select(
        *[f"`{c}`" for c in feats.columns if c not in (*NUMBERS, "tfidf_idx", "tfidf_val")],
        *[F.round(c, 6).alias(c) for c in NUMBERS],
        _sparse_as_text().alias("tfidf"),
    )


FITTED_SQL = f"""WITH known AS (SELECT d.* FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)),
moments AS (SELECT avg(n_chars) AS m, stddev_pop(n_chars) AS s FROM known),
domains AS (SELECT DISTINCT 1 AS part, 'lang' AS col, lang AS label FROM known WHERE lang IS NOT NULL
            UNION ALL SELECT DISTINCT 2, 'source', source FROM known WHERE source IS NOT NULL),
raw AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS label FROM documents),
tf AS (SELECT doc_id, label, count(*) AS tf FROM raw WHERE NOT list_contains({STOP_SQL}, label) GROUP BY 1, 2),
terms AS (
  SELECT label, ln((1.0::DOUBLE + (SELECT count(*) FROM known)) / (1.0::DOUBLE + count(*))) + 1.0::DOUBLE AS idf
  FROM tf WHERE doc_id IN (SELECT doc_id FROM known) GROUP BY 1 ORDER BY sum(tf) DESC, label LIMIT 5000),
feats AS (
  SELECT *, row_number() OVER (ORDER BY part, label) AS idx  -- 0 is the number
  FROM (SELECT part, col, label, NULL::DOUBLE AS idf FROM domains UNION ALL SELECT 3, 'text', label, idf FROM terms)),
e AS (
  SELECT doc_id, 0 AS idx, (n_chars - m) / CASE WHEN s > 0 THEN s ELSE 1 END AS val FROM documents, moments WHERE n_chars IS NOT NULL
  UNION ALL SELECT doc_id, idx, 1 FROM documents JOIN feats ON col = 'lang' AND label = lang
  UNION ALL SELECT doc_id, idx, 1 FROM documents JOIN feats ON col = 'source' AND label = source
  UNION ALL SELECT doc_id, idx, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) FROM tf JOIN feats USING (label) WHERE col = 'text'),
v AS (SELECT doc_id, string_agg(idx || ':' || CAST(CAST(val AS DECIMAL(12, 5)) AS VARCHAR), ' ' ORDER BY idx) AS features FROM e GROUP BY 1)
SELECT doc_id, coalesce(features, '') AS features FROM documents LEFT JOIN v USING (doc_id)"""


@register("fitted_features", FITTED_SQL)
def fitted_document_features(spark, d):
    """Fitted on the documents that have a label, applied to all of them."""
    docs = read_table(spark, d, "documents")
    known = docs.join(read_table(spark, d, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    spec = fitted.FeatureSpec("doc_id", numeric=("n_chars",), categorical=("lang", "source"), text="text")
    path = scratch_path(spark, "fitted-features")
    fitted.fit_features(spread(known, "doc_id"), spec, path)
    out = fitted.transform_features(spread(docs, "doc_id"), path)
    text = F.transform(F.arrays_zip("idx", "val"), lambda z: F.concat(
        z["idx"].cast("string"), F.lit(":"), F.round(z["val"], 5).cast("decimal(12,5)").cast("string")))
    return out.select("doc_id", F.array_join(text, " ").alias("features"))

"""Queries: the catalogue cleaning stages on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogprep.functions.dates import age_in_years, date_int_parts, date_text_parts, parse_text_date
from catalogprep.functions.strings import first_number, split_literal, to_int
from catalogprep.operators import classify as C
from catalogprep.operators import multivalue as M
from catalogprep.operators.stats import exact_quantiles, quantile_columns
from catalogprep.operators.features import calendar_features
from catalogprep.operators.quality import fill_nulls
from catalogprep.plans import oracle_sql as S
from catalogprep.plans import standins
from catalogprep.plans.catalog_job import clean_titles, run
from catalogprep.plans.registry import register, render
from catalogprep.session import scratch_path
from catalogprep.sources import writers as W
from catalogprep.sources.readers import read_table

# --------------------------------------------------------------------------
# parts as titles: small parts are "movies", the rest "shows"; the name is the
# genre text and "red" plays the role of "International".
# --------------------------------------------------------------------------


def _parts_as_titles(spark, d):
    p = read_table(spark, d, "part")
    return p.select(
        "p_partkey", "p_size", "p_brand",
        F.when(F.col("p_size") <= 25, "Movie").otherwise("TV Show").alias("type"),
        F.col("p_name").alias("listed_in"),
    )


PARTS_SQL = """parts AS (
  SELECT p_partkey, p_size, p_brand, CASE WHEN p_size <= 25 THEN 'Movie' ELSE 'TV Show' END AS type,
         p_name AS listed_in FROM part)"""

REACH_SQL = """reach AS (
  SELECT *, CASE WHEN type = 'Movie' THEN CASE WHEN contains(listed_in, 'red') THEN 'Global' ELSE 'Local' END END AS movie_type,
            CASE WHEN type = 'TV Show' THEN CASE WHEN contains(listed_in, 'red') THEN 'Global' ELSE 'Local' END END AS show_type
  FROM parts)"""


@register(
    "reach_classification",
    S.with_(PARTS_SQL, REACH_SQL)
    + """SELECT coalesce(movie_type, show_type) AS reach,
       count(*) FILTER (WHERE type = 'Movie') AS n_movie, count(*) FILTER (WHERE type = 'TV Show') AS n_tv_show
FROM reach WHERE coalesce(movie_type, show_type) IS NOT NULL GROUP BY 1""",
)
def reach_classification(spark, d):
    return C.reach_type_matrix(C.reach_classification(_parts_as_titles(spark, d), marker="red"))


@register(
    "reach_rows",
    S.with_(PARTS_SQL, REACH_SQL) + "SELECT p_partkey, type, movie_type, show_type FROM reach",
)
def reach_rows(spark, d):
    df = C.reach_classification(_parts_as_titles(spark, d), marker="red")
    return df.select("p_partkey", "type", "movie_type", "show_type")


@register(
    "typed_unit_split",
    S.with_(PARTS_SQL, """durations AS (
  SELECT p_partkey, type, p_size,
         CASE WHEN p_brand = 'Brand#1' THEN 'unknown'
              WHEN type = 'Movie' THEN CAST(p_size * 4 AS VARCHAR) || ' min'
              WHEN p_size = 26 THEN '1 Season'
              ELSE CAST(p_size - 25 AS VARCHAR) || ' Seasons' END AS duration,
         ' ' || CAST(1970 + p_size AS VARCHAR) || ' ' AS year_text
  FROM parts)""")
    + """SELECT p_partkey, type, duration,
       CASE WHEN type = 'Movie' THEN TRY_CAST(regexp_replace(duration, ' min', '', 'g') AS INTEGER) END AS movie_duration,
       CASE WHEN type = 'TV Show' THEN TRY_CAST(regexp_replace(duration, '\\D', '', 'g') AS INTEGER) END AS seasons,
       TRY_CAST(nullif(regexp_extract(duration, '(\\d+)', 1), '') AS DOUBLE) AS first_number,
       TRY_CAST(year_text AS INTEGER) AS release_year
FROM durations""",
)
def typed_unit_split(spark, d):
    p = _parts_as_titles(spark, d)
    size = F.col("p_size")
    duration = (
        F.when(F.col("p_brand") == "Brand#1", F.lit("unknown"))
        .when(F.col("type") == "Movie", F.concat((size * 4).cast("string"), F.lit(" min")))
        .when(size == 26, F.lit("1 Season"))
        .otherwise(F.concat((size - 25).cast("string"), F.lit(" Seasons")))
    )
    year_text = F.concat(F.lit(" "), (size + 1970).cast("string"), F.lit(" "))
    df = p.select("p_partkey", "type", duration.alias("duration"), year_text.alias("year_text"))
    df = C.split_duration(df, drop=False)
    return df.select(
        "p_partkey", "type", "duration", "movie_duration", "seasons",
        first_number("duration").alias("first_number"), to_int("year_text").alias("release_year"),
    )


@register(
    "split_trim_explode",
    """WITH lists AS (
  SELECT p_partkey,
         CASE WHEN p_size <= 5 THEN ', ' || replace(p_name, ' ', ',  ')
              WHEN p_size > 45 THEN NULL
              ELSE replace(p_name, ' ', ', ') END AS raw
  FROM part),
arrs AS (SELECT p_partkey, regexp_split_to_array(regexp_replace(raw, '^\\s*,\\s*', ''), ',\\s*') AS arr FROM lists)
SELECT p_partkey, unnest(CASE WHEN arr IS NULL OR len(arr) = 0 THEN [NULL]::VARCHAR[] ELSE arr END) AS item FROM arrs""",
)
def split_trim_explode(spark, d):
    p = read_table(spark, d, "part")
    raw = (
        F.when(F.col("p_size") <= 5, F.concat(F.lit(", "), F.replace("p_name", F.lit(" "), F.lit(",  "))))
        .when(F.col("p_size") > 45, F.lit(None).cast("string"))
        .otherwise(F.replace("p_name", F.lit(" "), F.lit(", ")))
    )
    df = M.explode_members(p.select("p_partkey", raw.alias("raw")), "raw", member_col="item", lists_col="items")
    return df.select("p_partkey", "item")


# --------------------------------------------------------------------------
# dates
# --------------------------------------------------------------------------

DATE_TEXT_SQL = """dt AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'Unknown'
              WHEN o_orderpriority = '2-HIGH' THEN ' ' || strftime(o_orderdate, '%B %-d, %Y')
              WHEN o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%B %-d')
              ELSE strftime(o_orderdate, '%B %-d, %Y') END AS date_added
  FROM orders),
parsed AS (SELECT o_orderkey, date_added, CAST(try_strptime(trim(date_added), '%B %d, %Y') AS DATE) AS added_date FROM dt)"""


@register(
    "date_text_parts",
    S.with_(DATE_TEXT_SQL)
    + """SELECT o_orderkey, date_added, added_date, strftime(added_date, '%Y') AS year, strftime(added_date, '%B') AS month,
       strftime(added_date, '%-d') AS day, strftime(added_date, '%A') AS day_of_week FROM parsed""",
)
def date_text_parts_q(spark, d):
    o = read_table(spark, d, "orders")
    prio = F.col("o_orderpriority")
    text = (
        F.when(prio == "1-URGENT", F.lit("Unknown"))
        .when(prio == "2-HIGH", F.concat(F.lit(" "), F.date_format("o_orderdate", "MMMM d, yyyy")))
        .when(prio == "3-MEDIUM", F.date_format("o_orderdate", "MMMM d"))
        .otherwise(F.date_format("o_orderdate", "MMMM d, yyyy"))
    )
    df = o.select("o_orderkey", text.alias("date_added"))
    df = df.withColumn("added_date", parse_text_date("date_added"))
    return df.withColumns(date_text_parts("added_date"))


@register(
    "date_int_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS added_year, CAST(month(o_orderdate) AS INTEGER) AS added_month,
       CAST(day(o_orderdate) AS INTEGER) AS added_day, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS added_dayofweek
FROM orders""",
)
def date_int_parts_q(spark, d):
    o = read_table(spark, d, "orders")
    return o.select("o_orderkey", *[c.alias(n) for n, c in date_int_parts(F.to_date("o_orderdate")).items()])


AS_OF = 2025


@register(
    "age_summary",
    f"""SELECT o_orderstatus, count(*) AS n, avg({AS_OF} - year(o_orderdate)) AS mean_age,
       median({AS_OF} - year(o_orderdate)) AS median_age
FROM orders GROUP BY o_orderstatus""",
)
def age_summary(spark, d):
    o = read_table(spark, d, "orders").select("o_orderstatus", age_in_years(F.year("o_orderdate"), AS_OF).alias("age"))
    moments = o.groupBy("o_orderstatus").agg(F.avg("age").alias("mean_age"))
    med = quantile_columns(exact_quantiles(o, "age", [0.5], ["o_orderstatus"]), ["o_orderstatus"], {0.5: "median_age"})
    return moments.join(med, "o_orderstatus")


# --------------------------------------------------------------------------
# country validation and language enrichment
# --------------------------------------------------------------------------


def _order_lists(spark, d):
    t = standins.titles_from_orders(spark, d).select("show_id", "country")
    return fill_nulls(t, {"country": "Unknown"})


SPLIT_SQL = """split AS (
  SELECT show_id, regexp_split_to_array(regexp_replace(coalesce(country, 'Unknown'), '^\\s*,\\s*', ''), ',\\s*') AS countries
  FROM titles),
exploded AS (SELECT show_id, countries, unnest(countries) AS c FROM split)"""


@register(
    "invalid_members",
    S.with_(S.TITLES, S.VALID, SPLIT_SQL)
    + "SELECT DISTINCT c AS country FROM exploded WHERE c NOT IN (SELECT country FROM valid_countries)",
)
def invalid_members(spark, d):
    ex = M.explode_members(_order_lists(spark, d))
    return M.invalid_members(ex, standins.valid_nations(spark, d))


@register(
    "country_validate",
    S.with_(S.TITLES, S.VALID, SPLIT_SQL)
    + """SELECT show_id, c AS country,
       array_to_string(CASE WHEN c IS NOT NULL AND c NOT IN (SELECT country FROM valid_countries)
                            THEN ['Unknown'] ELSE countries END, ', ') AS country_clean
FROM exploded""",
)
def country_validate(spark, d):
    ex = M.explode_members(_order_lists(spark, d))
    out = M.flag_invalid_members(ex, standins.valid_nations(spark, d))
    return out.select("show_id", "country", render("country_clean").alias("country_clean"))


# The oracle follows the published algorithm literally: explode, flag, inner
# join with the map, union languages per list value, join back, de-duplicate.
COMPAT_SQL = """flagged AS (
  SELECT e.*, CASE WHEN c IS NOT NULL AND c NOT IN (SELECT country FROM valid_countries)
                   THEN ['Unknown'] ELSE countries END AS country_clean
  FROM exploded e),
joined AS (SELECT f.*, m.Languages FROM flagged f JOIN lang_map m ON m.country = f.c),
langs AS (
  SELECT country_clean, list_sort(list_distinct(list(lang))) AS released_languages
  FROM (SELECT country_clean, unnest(Languages) AS lang FROM joined) GROUP BY country_clean),
enriched AS (
  SELECT DISTINCT j.show_id, j.country_clean AS released_countries, l.released_languages
  FROM joined j LEFT JOIN langs l ON l.country_clean = j.country_clean)"""


@register(
    "country_language_enrich",
    S.with_(S.TITLES, S.VALID, S.LANG_MAP, SPLIT_SQL, COMPAT_SQL)
    + """SELECT show_id, array_to_string(released_countries, ', ') AS released_countries,
       array_to_string(released_languages, ', ') AS released_languages FROM enriched""",
)
def country_language_enrich(spark, d):
    out = M.enrich_languages(
        _order_lists(spark, d), standins.valid_nations(spark, d), standins.nation_languages(spark, d), mode="compat"
    )
    return out.select("show_id", render("released_countries").alias("released_countries"),
                      render("released_languages").alias("released_languages"))


KEEP_ALL_SQL = """ex AS (SELECT show_id, countries, unnest(countries) AS c, unnest(range(len(countries))) AS pos FROM split),
info AS (
  SELECT coalesce(v.country, m.country) AS country, v.country IS NOT NULL AS is_valid,
         m.country IS NOT NULL AS is_mapped, m.languages
  FROM (SELECT DISTINCT country FROM valid_countries) v
  FULL OUTER JOIN (SELECT country, list_distinct(flatten(list(Languages))) AS languages FROM lang_map GROUP BY country) m
  ON v.country = m.country),
j AS (SELECT ex.*, coalesce(i.is_valid, false) AS is_valid, coalesce(i.is_mapped, false) AS is_mapped, i.languages
      FROM ex LEFT JOIN info i ON i.country = ex.c),
per AS (
  SELECT show_id, list(CASE WHEN is_valid THEN c ELSE 'Unknown' END ORDER BY pos) AS cl,
         coalesce(list_sort(list_distinct(flatten(list(languages) FILTER (WHERE is_valid AND is_mapped)))), []) AS langs
  FROM j GROUP BY show_id)"""


@register(
    "enrich_keep_all",
    S.with_(S.TITLES, S.VALID, S.LANG_MAP, SPLIT_SQL, KEEP_ALL_SQL)
    + """SELECT show_id, array_to_string(list_filter(cl, lambda x, i: list_position(cl, x) = i), ', ') AS released_countries,
       array_to_string(langs, ', ') AS released_languages FROM per""",
)
def enrich_keep_all(spark, d):
    out = M.enrich_languages(
        _order_lists(spark, d), standins.valid_nations(spark, d), standins.nation_languages(spark, d), mode="keep_all"
    )
    return out.select("show_id", render("released_countries").alias("released_countries"),
                      render("released_languages").alias("released_languages"))


# --------------------------------------------------------------------------
# the whole job
# --------------------------------------------------------------------------

JOB_SQL = """filled AS (
  SELECT show_id, type, title, coalesce(director, 'Unknown') AS director, coalesce("cast", 'Unknown') AS "cast",
         coalesce(country, 'Unknown') AS country, date_added, release_year, rating, duration, listed_in, description
  FROM titles),
dropped AS (
  SELECT * FROM filled WHERE show_id IS NOT NULL AND type IS NOT NULL AND title IS NOT NULL AND date_added IS NOT NULL
    AND release_year IS NOT NULL AND rating IS NOT NULL AND duration IS NOT NULL AND listed_in IS NOT NULL
    AND description IS NOT NULL),
shaped AS (
  SELECT *,
    CASE WHEN type = 'Movie' THEN CASE WHEN contains(listed_in, 'International') THEN 'Global' ELSE 'Local' END END AS movie_type,
    CASE WHEN type = 'TV Show' THEN CASE WHEN contains(listed_in, 'International') THEN 'Global' ELSE 'Local' END END AS show_type,
    regexp_split_to_array(listed_in, ',\\s*') AS genres,
    CAST(try_strptime(trim(date_added), '%B %d, %Y') AS DATE) AS added_date,
    regexp_split_to_array(regexp_replace(country, '^\\s*,\\s*', ''), ',\\s*') AS countries
  FROM dropped),
exploded AS (SELECT *, unnest(countries) AS c FROM shaped),
flagged AS (
  SELECT e.*, CASE WHEN c IS NOT NULL AND c NOT IN (SELECT country FROM valid_countries)
                   THEN ['Unknown'] ELSE countries END AS country_clean
  FROM exploded e),
joined AS (SELECT f.*, m.Languages FROM flagged f JOIN lang_map m ON m.country = f.c),
langs AS (
  SELECT country_clean, list_sort(list_distinct(list(lang))) AS released_languages
  FROM (SELECT country_clean, unnest(Languages) AS lang FROM joined) GROUP BY country_clean),
result AS (
  SELECT DISTINCT j.show_id, j.type, j.title, j.director, j."cast", j.date_added, j.release_year, j.rating,
         j.duration, j.description, j.country_clean AS released_countries, l.released_languages,
         j.movie_type, j.show_type, j.genres, j.added_date
  FROM joined j LEFT JOIN langs l ON l.country_clean = j.country_clean)"""


CLEAN_JOB_SQL = (
    S.with_(S.TITLES, S.VALID, S.LANG_MAP, JOB_SQL)
    + """SELECT show_id, type, title, director, "cast", date_added, TRY_CAST(release_year AS INTEGER) AS release_year, rating,
       CASE WHEN type = 'Movie' THEN TRY_CAST(regexp_replace(duration, ' min', '', 'g') AS INTEGER) END AS movie_duration,
       CASE WHEN type = 'TV Show' THEN TRY_CAST(regexp_replace(duration, '\\D', '', 'g') AS INTEGER) END AS seasons,
       description, array_to_string(released_countries, ', ') AS released_countries,
       array_to_string(released_languages, ', ') AS released_languages, movie_type, show_type,
       array_to_string(genres, ', ') AS genres, added_date, strftime(added_date, '%Y') AS year,
       strftime(added_date, '%B') AS month, strftime(added_date, '%-d') AS day, strftime(added_date, '%A') AS day_of_week
FROM result"""
)


@register(
    "catalog_clean_job",
    CLEAN_JOB_SQL,
)
def catalog_clean_job(spark, d):
    res = clean_titles(
        standins.titles_from_orders(spark, d), standins.valid_nations(spark, d), standins.nation_languages(spark, d)
    )
    return res.titles.withColumns({c: render(c) for c in ("released_countries", "released_languages", "genres")})


CLEAN_PROFILE_SQL = (
    S.with_(S.TITLES, """agg AS (
  SELECT count(*) AS total_rows,
         count(*) FILTER (WHERE type IS NOT NULL AND title IS NOT NULL AND date_added IS NOT NULL AND release_year IS NOT NULL
                  AND rating IS NOT NULL AND duration IS NOT NULL AND listed_in IS NOT NULL AND description IS NOT NULL
                  AND show_id IS NOT NULL) AS rows_after_drop,
         """ + ", ".join(f'count(*) FILTER (WHERE "{c}" IS NULL) AS n{i}' for i, c in enumerate(
        ["show_id", "type", "title", "director", "cast", "country", "date_added", "release_year", "rating",
         "duration", "listed_in", "description"])) + " FROM titles)")
    + "\n  UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, n{i} AS null_count, "
        f"CAST(n{i} AS DOUBLE) * 100.0::DOUBLE / total_rows AS null_pct, "
        + ("CAST(0 AS BIGINT)" if c in ("director", "cast", "country") else f"n{i}") + " AS nulls_after_fill, "
        + ("CAST(0 AS DOUBLE)" if c in ("director", "cast", "country") else f"CAST(n{i} AS DOUBLE) * 100.0::DOUBLE")
        + " / total_rows AS pct_after_fill, total_rows, rows_after_drop FROM agg"
        for i, c in enumerate(["show_id", "type", "title", "director", "cast", "country", "date_added",
                               "release_year", "rating", "duration", "listed_in", "description"])
    )
)


@register(
    "catalog_null_profile",
    CLEAN_PROFILE_SQL,
)
def catalog_null_profile(spark, d):
    res = clean_titles(
        standins.titles_from_orders(spark, d), standins.valid_nations(spark, d), standins.nation_languages(spark, d)
    )
    return res.null_profile


def _job_from_files(spark, d):
    """The job as users run it: a titles CSV, a list of valid countries and a JSON array of
    records are written and read back by ``run``, whose Parquet output is read back too."""
    base = scratch_path(spark, "catalog-job")
    W.write_csv(standins.titles_from_orders(spark, d), f"{base}/titles")
    W.write_valid_countries(standins.valid_nations(spark, d), f"{base}/valid", header=True)
    W.write_language_map(standins.nation_languages(spark, d), f"{base}/languages", shape="array")
    return run(spark, f"{base}/titles", f"{base}/valid", f"{base}/languages", f"{base}/clean")


@register("job_from_files", CLEAN_JOB_SQL)
def job_from_files(spark, d):
    res = _job_from_files(spark, d)
    return res.titles.withColumns({c: render(c) for c in ("released_countries", "released_languages", "genres")})


@register("job_load_profile", CLEAN_PROFILE_SQL)
def job_load_profile(spark, d):
    return _job_from_files(spark, d).null_profile


@register(
    "language_enrich_joined",
    S.with_(S.TITLES, S.VALID, S.LANG_MAP, SPLIT_SQL, COMPAT_SQL)
    + """SELECT show_id, array_to_string(released_countries, ', ') AS released_countries,
       array_to_string(released_languages, ', ') AS released_languages FROM enriched""",
)
def language_enrich_joined(spark, d):
    """The path for lookups too large for one value per row; same rows."""
    out = M.enrich_languages(_order_lists(spark, d), standins.valid_nations(spark, d),
                             standins.nation_languages(spark, d), mode="compat", max_lookup_rows=0)
    return out.select("show_id", render("released_countries").alias("released_countries"),
                      render("released_languages").alias("released_languages"))


@register(
    "literal_split_calendar",
    """SELECT o_orderkey, o_orderstatus AS first_part, o_orderpriority AS second_part,
       CAST(year(o_orderdate) AS INTEGER) AS added_year, CAST(month(o_orderdate) AS INTEGER) AS added_month,
       CAST(day(o_orderdate) AS INTEGER) AS added_day, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS added_dayofweek
FROM orders""",
)
def literal_split_calendar(spark, d):
    """A literal separator with regex signs, and calendar features of ISO date text."""
    o = read_table(spark, d, "orders").select(
        "o_orderkey", F.concat("o_orderstatus", F.lit(" .* "), "o_orderpriority").alias("both"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("added"))
    parts = split_literal("both", " .* ")
    out = calendar_features(o.withColumns({"first_part": parts[0], "second_part": parts[1]}), "added")
    return out.drop("both")

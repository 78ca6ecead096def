"""Queries: counts, pivots, contingency tables, shares, top-N."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogprep.functions.dates import WEEKDAYS
from catalogprep.functions.strings import split_trim
from catalogprep.operators import profile as P
from catalogprep.operators.multivalue import member_list
from catalogprep.plans import oracle_sql as S
from catalogprep.plans import standins
from catalogprep.plans.registry import register
from catalogprep.sources.readers import read_table

YEARS = list(range(1995, 2002))  # order years in the generated data (oracle side)
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register(
    "value_counts",
    S.with_(S.ORDERS_WITH_NULLS)
    + "SELECT o_orderpriority, count(*) AS n FROM orders_n WHERE o_orderpriority IS NOT NULL GROUP BY 1",
)
def value_counts(spark, d):
    return P.value_counts(standins.orders_with_nulls(spark, d), "o_orderpriority")


@register(
    "value_counts_by_value",
    S.with_(S.EVENTS_WITH_NULLS)
    + "SELECT event_type, count(*) AS n FROM events_n WHERE event_type IS NOT NULL GROUP BY 1",
)
def value_counts_by_value(spark, d):
    return P.value_counts(standins.events_with_nulls(spark, d), "event_type", sort="value")


@register(
    "two_key_counts",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, count(*) AS count
FROM orders GROUP BY 1, 2""",
)
def two_key_counts(spark, d):
    o = read_table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), "o_orderstatus")
    return P.group_counts(o, "year", "o_orderstatus")


@register(
    "year_type_pivot",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
       count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P", count(*) AS total
FROM orders GROUP BY 1""",
)
def year_type_pivot(spark, d):
    o = read_table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), "o_orderstatus")
    return P.pivot_counts(o, "year", "o_orderstatus")


@register(
    "month_year_pivot",
    """WITH long AS (
  SELECT CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS count
  FROM orders GROUP BY 1, 2)
SELECT month, """
    + ", ".join(f'CAST(coalesce(sum(count) FILTER (WHERE year = {y}), 0) AS BIGINT) AS "{y}"' for y in YEARS)
    + " FROM long GROUP BY month",
)
def month_year_pivot(spark, d):
    o = read_table(spark, d, "orders").select(F.month("o_orderdate").alias("month"), F.year("o_orderdate").alias("year"))
    long = P.group_counts(o, "month", "year")
    return P.pivot_sum(long, "month", "year", "count")


@register(
    "crosstab",
    "SELECT o_orderstatus, "
    + ", ".join(f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in PRIORITIES)
    + " FROM orders GROUP BY 1",
)
def crosstab(spark, d):
    return P.crosstab(read_table(spark, d, "orders"), "o_orderstatus", "o_orderpriority")


@register(
    "crosstab_row_share",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n,
       count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus) AS share
FROM orders GROUP BY 1, 2""",
)
def crosstab_row_share(spark, d):
    return P.row_share(read_table(spark, d, "orders"), "o_orderstatus", "o_orderpriority")


@register(
    "weekday_ordered",
    "WITH days(ord, day_of_week) AS (VALUES "
    + ", ".join(f"({i}, '{w}')" for i, w in enumerate(WEEKDAYS))
    + """),
counts AS (SELECT strftime(ts, '%A') AS day_of_week, count(*) AS n FROM events GROUP BY 1)
SELECT CAST(ord AS INTEGER) AS ord, day_of_week, n FROM days LEFT JOIN counts USING (day_of_week)""",
)
def weekday_ordered(spark, d):
    e = read_table(spark, d, "events").select(F.date_format("ts", "EEEE").alias("day_of_week"))
    return P.reindex(P.value_counts(e, "day_of_week", sort="none"), "day_of_week", list(WEEKDAYS))


@register(
    "recent_years",
    """WITH piv AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
         count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P", count(*) AS total
  FROM orders GROUP BY 1)
SELECT *, total > 2000 AS labelled FROM piv WHERE year >= (SELECT max(year) FROM piv) - 3""",
)
def recent_years(spark, d):
    o = read_table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), "o_orderstatus")
    piv = P.pivot_counts(o, "year", "o_orderstatus")
    return P.label_threshold(P.recent_window(piv, "year", 3), "total", 2000)


@register(
    "topn",
    "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 10",
)
def topn(spark, d):
    return P.top_n(read_table(spark, d, "part"), "p_brand", 10)


@register(
    "topn_exploded",
    S.with_(S.LISTS)
    + """SELECT value, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(country, ',\\s*')) AS value FROM lists)
GROUP BY 1 ORDER BY n DESC, value LIMIT 20""",
)
def topn_exploded(spark, d):
    lists = standins.order_country_lists(spark, d).select(F.explode(member_list("country")).alias("value"))
    return P.top_n(lists, "value", 20)


@register(
    "topn_per_group",
    """SELECT * FROM (
  SELECT l_returnflag, l_suppkey, count(*) AS n,
         CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, l_suppkey) AS INTEGER) AS rank
  FROM lineitem GROUP BY 1, 2) WHERE rank <= 10""",
)
def topn_per_group(spark, d):
    return P.top_n_per_group(read_table(spark, d, "lineitem"), "l_returnflag", "l_suppkey", 10)


@register(
    "topn_semi_filter",
    """WITH lp AS (SELECT p_brand, l_returnflag FROM lineitem JOIN part ON l_partkey = p_partkey),
top AS (SELECT p_brand FROM lp GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 5)
SELECT p_brand, l_returnflag, count(*) AS count FROM lp WHERE p_brand IN (SELECT p_brand FROM top) GROUP BY 1, 2""",
)
def topn_semi_filter(spark, d):
    li = read_table(spark, d, "lineitem").select("l_partkey", "l_returnflag")
    pa = read_table(spark, d, "part").select("p_partkey", "p_brand")
    lp = li.join(pa, li["l_partkey"] == pa["p_partkey"]).select("p_brand", "l_returnflag")
    return P.group_counts(P.semi_filter_top(lp, "p_brand", 5), "p_brand", "l_returnflag")


@register(
    "topn_outer_align",
    """WITH a AS (SELECT p_brand, count(*) AS n_movie FROM part WHERE p_size <= 25 GROUP BY 1 ORDER BY n_movie DESC, p_brand LIMIT 10),
b AS (SELECT p_brand, count(*) AS n_tv_show FROM part WHERE p_size > 25 GROUP BY 1 ORDER BY n_tv_show DESC, p_brand LIMIT 10)
SELECT coalesce(a.p_brand, b.p_brand) AS p_brand, coalesce(n_movie, 0) AS n_movie, coalesce(n_tv_show, 0) AS n_tv_show
FROM a FULL OUTER JOIN b ON a.p_brand = b.p_brand""",
)
def topn_outer_align(spark, d):
    p = read_table(spark, d, "part")
    a = P.top_n(p.where(F.col("p_size") <= 25), "p_brand", 10, count_col="n_movie")
    b = P.top_n(p.where(F.col("p_size") > 25), "p_brand", 10, count_col="n_tv_show")
    return P.outer_align(a, b, "p_brand", "n_movie", "n_tv_show")


@register(
    "percent_share",
    """SELECT event_type, count(*) AS n, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM events WHERE event_type IS NOT NULL) AS pct
FROM events WHERE event_type IS NOT NULL GROUP BY 1""",
)
def percent_share(spark, d):
    return P.percent_share(read_table(spark, d, "events"), "event_type")


@register(
    "cast_top",
    """WITH t AS (SELECT CASE WHEN p_brand = 'Brand#1' THEN 'Unknown' ELSE replace(p_name, ' ', ' ,') END AS cast_list FROM part),
m AS (SELECT unnest(list_transform(string_split(cast_list, ','), lambda x: trim(x))) AS member FROM t
      WHERE cast_list IS NOT NULL AND cast_list <> 'Unknown')
SELECT member, count(*) AS n FROM m GROUP BY 1 ORDER BY n DESC, member LIMIT 20""",
)
def cast_top(spark, d):
    p = read_table(spark, d, "part")
    cast_list = F.when(F.col("p_brand") == "Brand#1", F.lit("Unknown")).otherwise(
        F.replace("p_name", F.lit(" "), F.lit(" ,"))
    )
    t = p.select(cast_list.alias("cast_list")).where(F.col("cast_list").isNotNull() & (F.col("cast_list") != "Unknown"))
    members = t.select(F.explode(split_trim("cast_list", ",")).alias("member"))
    return P.top_n(members, "member", 20)

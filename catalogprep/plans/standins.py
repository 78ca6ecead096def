"""Catalogue stand-ins built from the driver's TPC-H-style tables.

There is no titles table among the driver's tables, so the catalogue
operators run on data Spark derives from them (its size grows with theirs):

* a title per order; its "country list" is the sorted distinct nations of
  the order's suppliers joined by ``', '`` (NULL for an order without lines);
* the valid-country list is every nation outside region 4;
* the language map gives each nation its region's language (Asian nations
  also their own), leaves out the European nations above key 15, and lists
  NATION_1 twice — so every path of validation is exercised: valid and
  mapped, valid but unmapped, mapped but invalid, duplicated entry.

Each builder has a DuckDB twin in :mod:`catalogprep.plans.oracle_sql`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogprep.operators._common import spread
from catalogprep.sources.readers import read_table

#: Nulls injected identically in Spark and in the oracle (no driver column
#: holds a NULL).
def events_with_nulls(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events")
    return e.select(
        "event_id",
        "ts",
        F.when(F.col("user_id") != 0, F.col("user_id")).alias("user_id"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 5, F.col("value")).alias("value"),
        F.when(~F.col("props").contains("\"k\": 1"), F.col("props")).alias("props"),
    )


def orders_with_nulls(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_custkey") >= 100, F.col("o_custkey")).alias("o_custkey"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        F.when(F.col("o_totalprice") >= 5000, F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"),
    )


def order_country_lists(spark: SparkSession, d: str) -> DataFrame:
    """``o_orderkey, country`` — distinct supplier nations per order."""
    # a thin (single row-group) lineitem is spread by order key so the join
    # and the per-order aggregate run in parallel and the aggregate reuses the
    # partitioning; an already-split lineitem is left as is
    li = spread(read_table(spark, d, "lineitem").select("l_orderkey", "l_suppkey"), "l_orderkey")
    su = read_table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    # nation has 25 rows at every scale factor (fixed by the TPC-H schema)
    na = F.broadcast(read_table(spark, d, "nation").select("n_nationkey", "n_name"))
    sup_nation = su.join(na, su["s_nationkey"] == na["n_nationkey"]).select("s_suppkey", "n_name")
    # the planner and AQE decide by bytes whether supplier -> nation is broadcast
    lines = li.join(sup_nation, li["l_suppkey"] == sup_nation["s_suppkey"])
    # collect_set per order is bounded by the number of nations.
    return lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.array_join(F.array_sort(F.collect_set("n_name")), ", ").alias("country")
    )


def valid_nations(spark: SparkSession, d: str) -> DataFrame:
    n = read_table(spark, d, "nation")
    return n.where(F.col("n_regionkey") != 4).select(F.col("n_name").alias("country"))


def nation_languages(spark: SparkSession, d: str) -> DataFrame:
    n = read_table(spark, d, "nation")
    r = read_table(spark, d, "region")
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    region_lang = F.concat(F.lit("lang_"), F.lower("r_name"))
    own_lang = F.concat(F.lit("lang_"), F.lower("n_name"))
    main = j.where(~((F.col("r_name") == "EUROPE") & (F.col("n_nationkey") > 15))).select(
        F.col("n_name").alias("country"),
        F.when(F.col("r_name") == "ASIA", F.array(region_lang, own_lang))
        .otherwise(F.array(region_lang)).alias("Languages"),
    )
    extra = n.where(F.col("n_name") == "NATION_1").select(
        F.col("n_name").alias("country"), F.array(F.lit("lang_extra")).alias("Languages")
    )
    return main.unionByName(extra)


def _s(c: Column) -> Column:
    return c.cast("string")


def titles_from_orders(spark: SparkSession, d: str) -> DataFrame:
    """The 12 raw text columns of the titles CSV, one title per order."""
    o = read_table(spark, d, "orders")
    lists = order_country_lists(spark, d)
    t = o.join(lists, "o_orderkey", "left")
    status, prio, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    seasons = F.floor(price / 100000)
    duration = F.when(
        status == "O",
        F.concat(_s(seasons + 1), F.when(seasons == 0, F.lit(" Season")).otherwise(F.lit(" Seasons"))),
    ).otherwise(F.concat(_s(F.floor(price / 4000)), F.lit(" min")))
    genre_a = F.when(status == "F", "Dramas").when(status == "O", "Docuseries").otherwise("Comedies")
    genre_b = F.when(prio.isin("1-URGENT", "2-HIGH"), "International").otherwise("Independent")
    return t.select(
        F.concat(F.lit("s"), _s(F.col("o_orderkey"))).alias("show_id"),
        F.when(status == "O", "TV Show").otherwise("Movie").alias("type"),
        F.concat(F.lit("Order "), _s(F.col("o_orderkey"))).alias("title"),
        F.when(prio != "5-LOW", F.concat(F.lit("Clerk "), prio)).alias("director"),
        F.when(F.col("o_custkey") >= 100, F.concat(F.lit("Customer "), _s(F.col("o_custkey")))).alias("cast"),
        F.when(prio == "3-MEDIUM", F.concat(F.lit(", "), F.col("country")))
        .otherwise(F.col("country")).alias("country"),
        F.when((prio == "1-URGENT") & (status == "P"), F.lit("Unknown"))
        .otherwise(F.date_format("o_orderdate", "MMMM d, yyyy")).alias("date_added"),
        F.when((prio == "2-HIGH") & (status == "P"), F.lit("TV-PG"))
        .otherwise(_s(F.year("o_orderdate"))).alias("release_year"),
        prio.alias("rating"),
        duration.alias("duration"),
        F.concat(genre_a, F.lit(", "), genre_b).alias("listed_in"),
        F.when(price >= 5000, F.concat(F.lit("Order of customer "), _s(F.col("o_custkey")))).alias("description"),
    )

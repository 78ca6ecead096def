"""Queries: null profiles, fills, drops, dedupe, schema report."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogprep.operators import quality as Q
from catalogprep.plans import oracle_sql as S
from catalogprep.plans import standins
from catalogprep.plans.registry import register, render
from catalogprep.sources.readers import read_table

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _profile_sql(source: str, cols: list[str]) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS n{i}" for i, c in enumerate(cols))
    parts = "\n  UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, n{i} AS null_count, "
        f"CAST(n{i} AS DOUBLE) * 100.0::DOUBLE / total_rows AS null_pct, total_rows FROM agg"
        for i, c in enumerate(cols)
    )
    return f"agg AS (SELECT count(*) AS total_rows, {counts} FROM {source}),\nprof AS ({parts})"


@register("null_profile", S.with_(S.EVENTS_WITH_NULLS, _profile_sql("events_n", EVENT_COLS)) + "SELECT * FROM prof")
def null_profile(spark, d):
    return Q.null_profile(standins.events_with_nulls(spark, d))


@register(
    "missing_report_top",
    S.with_(S.ORDERS_WITH_NULLS, _profile_sql("orders_n", ORDER_COLS))
    + "SELECT column_name, null_count, null_pct FROM prof ORDER BY null_count DESC, column_name LIMIT 10",
)
def missing_report_top(spark, d):
    return Q.missing_report(standins.orders_with_nulls(spark, d), top=10)


ORDER_FILL = {"o_orderstatus": "Unknown", "o_orderpriority": "Unknown"}


@register(
    "fill_and_drop",
    S.with_(S.ORDERS_WITH_NULLS)
    + """SELECT o_orderkey, o_custkey, coalesce(o_orderstatus, 'Unknown') AS o_orderstatus, o_totalprice,
       o_orderdate, coalesce(o_orderpriority, 'Unknown') AS o_orderpriority
FROM orders_n
WHERE o_custkey IS NOT NULL AND o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL AND o_orderkey IS NOT NULL""",
)
def fill_and_drop(spark, d):
    cleaned, _ = Q.clean_nulls(standins.orders_with_nulls(spark, d), ORDER_FILL)
    return cleaned


def _fill_profile_sql() -> str:
    cols = ORDER_COLS
    counts = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS n{i}" for i, c in enumerate(cols))
    complete = " AND ".join(f"{c} IS NOT NULL" for c in cols if c not in ORDER_FILL)
    parts = []
    for i, c in enumerate(cols):
        after = "CAST(0 AS BIGINT)" if c in ORDER_FILL else f"n{i}"
        parts.append(
            f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, n{i} AS null_count, "
            f"CAST(n{i} AS DOUBLE) * 100.0::DOUBLE / total_rows AS null_pct, {after} AS nulls_after_fill, "
            f"CAST({after} AS DOUBLE) * 100.0::DOUBLE / total_rows AS pct_after_fill, total_rows, rows_after_drop FROM agg"
        )
    body = "\n  UNION ALL ".join(parts)
    return (
        S.with_(S.ORDERS_WITH_NULLS, f"agg AS (SELECT count(*) AS total_rows, count(*) FILTER (WHERE {complete}) AS rows_after_drop, {counts} FROM orders_n)")
        + body
    )


@register("fill_profile", _fill_profile_sql())
def fill_profile(spark, d):
    return Q.fill_profile(standins.orders_with_nulls(spark, d), ORDER_FILL)


@register(
    "dedupe_rows",
    """SELECT DISTINCT l_returnflag, l_linestatus, l_quantity,
       array_to_string([l_returnflag, l_linestatus], ', ') AS flags
FROM lineitem""",
)
def dedupe_rows(spark, d):
    li = read_table(spark, d, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", F.array("l_returnflag", "l_linestatus").alias("flags")
    )
    return Q.dedupe(li).withColumn("flags", render("flags"))


LINEITEM_TYPES = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
    ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
    ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]


def _schema_sql() -> str:
    parts = "\n  UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{t}' AS data_type, "
        f"count({c}) AS non_null_count FROM lineitem"
        for i, (c, t) in enumerate(LINEITEM_TYPES)
    )
    return parts


@register("schema_report", _schema_sql())
def schema_report(spark, d):
    return Q.schema_report(read_table(spark, d, "lineitem"))


@register(
    "preview_rows",
    "SELECT * FROM lineitem ORDER BY ALL LIMIT 5",
)
def preview_rows(spark, d):
    li = read_table(spark, d, "lineitem")
    return Q.preview(li, 5, li.columns)


@register("table_shape", "SELECT count(*) AS n_rows, CAST(6 AS INTEGER) AS n_columns FROM orders")
def table_shape(spark, d):
    return Q.shape(read_table(spark, d, "orders"))

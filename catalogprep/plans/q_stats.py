"""Queries: summary statistics, correlations, histograms, density, box plots."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from catalogprep.operators import distribution as D
from catalogprep.operators import stats as ST
from catalogprep.operators._common import spread
from catalogprep.plans.registry import register
from catalogprep.sources.readers import read_table

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
STATS = ("mean", "std", "min", "p25", "p50", "p75", "max")


def _describe_sql(table: str, cols: list[str], extra_null_cols: bool = False) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        cat = "CAST(NULL AS BIGINT) AS \"unique\", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, " if extra_null_cols else ""
        parts.append(
            f"SELECT '{c}' AS column_name, count({x}) AS count, {cat}round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, "
            f"round(quantile_cont({x}, 0.25), 6) AS p25, round(quantile_cont({x}, 0.5), 6) AS p50, "
            f"round(quantile_cont({x}, 0.75), 6) AS p75, round(max({x}), 6) AS max FROM {table}"
        )
    return "\nUNION ALL ".join(parts)


@register("describe_numeric", _describe_sql("lineitem", LI_NUM))
def describe_numeric(spark, d):
    return ST.describe_numeric(read_table(spark, d, "lineitem").select(*LI_NUM), decimals=6)


def _describe_all_sql() -> str:
    num = _describe_sql("orders", ["o_orderkey", "o_custkey", "o_totalprice"], extra_null_cols=True)
    cats = ["o_orderstatus", "o_orderdate", "o_orderpriority"]
    pairs = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM orders WHERE {c} IS NOT NULL" for c in cats
    )
    nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS {k}" for k in STATS)
    return f"""WITH pairs AS ({pairs}),
counts AS (SELECT column_name, value, count(*) AS freq FROM pairs GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY freq DESC, value) AS r FROM counts),
cat AS (
  SELECT c.column_name, sum(c.freq) AS count, count(*) AS "unique",
         max(CASE WHEN r = 1 THEN value END) AS top, max(CASE WHEN r = 1 THEN freq END) AS freq, {nulls}
  FROM ranked c GROUP BY 1)
{num}
UNION ALL SELECT column_name, CAST(count AS BIGINT), "unique", top, freq, {", ".join(STATS)} FROM cat"""


@register("describe_all", _describe_all_sql())
def describe_all(spark, d):
    return ST.describe_all(read_table(spark, d, "orders"), decimals=6)


LINEITEM_N = """WITH li AS (
  SELECT l_quantity, l_extendedprice, nullif(l_discount, 0.0) AS l_discount,
         CASE WHEN l_tax <= 0.06 THEN l_tax END AS l_tax
  FROM lineitem)"""


def _lineitem_n(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.select(
        "l_quantity", "l_extendedprice",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
        F.when(F.col("l_tax") <= 0.06, F.col("l_tax")).alias("l_tax"),
    )


def _corr_sql(source: str) -> str:
    cells = []
    for a in LI_NUM:
        for b in LI_NUM:
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            cells.append(
                f"SELECT '{a}' AS col_a, '{b}' AS col_b, CASE WHEN var_pop({a}) FILTER (WHERE {both}) > 0 "
                f"AND var_pop({b}) FILTER (WHERE {both}) > 0 THEN round(corr({a}, {b}), 6) END AS corr FROM {source}"
            )
    return "\nUNION ALL ".join(cells)


@register("corr_pairwise", LINEITEM_N + "\n" + _corr_sql("li"))
def corr_pairwise(spark, d):
    return ST.corr_matrix(_lineitem_n(spark, d), missing="pairwise", decimals=6)


@register(
    "corr_listwise",
    LINEITEM_N + ", lw AS (SELECT * FROM li WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in LI_NUM) + ")\n"
    + _corr_sql("lw"),
)
def corr_listwise(spark, d):
    return ST.corr_matrix(_lineitem_n(spark, d), missing="listwise", decimals=6)


@register(
    "corr_zero_fill",
    LINEITEM_N + ", zf AS (SELECT " + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in LI_NUM) + " FROM li)\n"
    + _corr_sql("zf"),
)
def corr_zero_fill(spark, d):
    return ST.corr_matrix(_lineitem_n(spark, d), missing="zero_fill", decimals=6)


def _hist_sql(table: str, col: str, bins: int) -> str:
    return f"""WITH ext AS (SELECT CAST(min({col}) AS DOUBLE) AS lo0, CAST(max({col}) AS DOUBLE) AS hi0 FROM {table}),
e AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM ext),
b AS (SELECT CAST(least(floor((CAST({col} AS DOUBLE) - lo) * {float(bins)!r}::DOUBLE / (hi - lo)), {bins - 1}) AS INTEGER) AS bin
      FROM {table}, e WHERE {col} IS NOT NULL),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT g.bin, lo + g.bin * ((hi - lo) / {float(bins)!r}::DOUBLE) AS bin_lo,
       lo + (g.bin + 1) * ((hi - lo) / {float(bins)!r}::DOUBLE) AS bin_hi, coalesce(c.n, 0) AS n
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) g CROSS JOIN e LEFT JOIN c ON c.bin = g.bin"""


@register("histogram10", _hist_sql("events", "value", 10))
def histogram10(spark, d):
    return D.histogram(read_table(spark, d, "events"), "value", 10)


@register("histogram30", _hist_sql("lineitem", "l_extendedprice", 30))
def histogram30(spark, d):
    return D.histogram(read_table(spark, d, "lineitem"), "l_extendedprice", 30)


SQRT_2PI = math.sqrt(2.0 * math.pi)


@register(
    "kde_grid",
    f"""WITH src AS (SELECT CAST(p_retailprice AS DOUBLE) AS v FROM part WHERE p_retailprice IS NOT NULL),
st AS (SELECT count(*) AS n, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi FROM src),
p AS (SELECT n, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw, lo, hi FROM st),
g AS (SELECT n, bw, lo - 3.0::DOUBLE * bw AS g_lo, hi + 3.0::DOUBLE * bw AS g_hi FROM p),
w AS (SELECT v, count(*) AS w FROM src GROUP BY v),
grid AS (SELECT CAST(range AS INTEGER) AS i FROM range(200)),
s AS (
  SELECT i, g_lo + i * ((g_hi - g_lo) / 199.0::DOUBLE) AS x, n, bw,
         sum(w * exp(-0.5::DOUBLE * pow((g_lo + i * ((g_hi - g_lo) / 199.0::DOUBLE) - v) / bw, 2.0::DOUBLE))) AS s
  FROM grid CROSS JOIN g CROSS JOIN w GROUP BY i, g_lo, g_hi, n, bw)
SELECT i, round(x, 6) AS x, round(s / (n * bw * {SQRT_2PI!r}::DOUBLE), 12) AS density FROM s""",
)
def kde_grid(spark, d):
    k = D.kde_grid(read_table(spark, d, "part"), "p_retailprice", points=200)
    return k.select("i", F.round("x", 6).alias("x"), F.round("density", 12).alias("density"))


@register(
    "boxplot_stats",
    """WITH s AS (SELECT event_type, CAST(value AS DOUBLE) AS v FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL),
q AS (SELECT event_type, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM s GROUP BY 1),
f AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM q)
SELECT f.event_type, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       min(v) FILTER (WHERE v >= lo AND v <= hi) AS whisker_lo, max(v) FILTER (WHERE v >= lo AND v <= hi) AS whisker_hi,
       count(*) FILTER (WHERE NOT (v >= lo AND v <= hi)) AS n_outliers
FROM s JOIN f ON s.event_type = f.event_type GROUP BY f.event_type, n, q1, median, q3""",
)
def boxplot_stats(spark, d):
    b = D.boxplot_stats(spread(read_table(spark, d, "events").select("event_type", "value")), "event_type", "value")
    return b.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@register(
    "binned_scatter",
    """WITH s AS (SELECT CAST(l_quantity AS DOUBLE) AS x, CAST(l_extendedprice AS DOUBLE) AS y, l_returnflag FROM lineitem
           WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL AND l_returnflag IS NOT NULL),
ext AS (SELECT min(x) AS xl, max(x) AS xh, min(y) AS yl, max(y) AS yh FROM s),
e AS (SELECT CASE WHEN xl = xh THEN xl - 0.5 ELSE xl END AS xlo, CASE WHEN xl = xh THEN xh + 0.5 ELSE xh END AS xhi,
             CASE WHEN yl = yh THEN yl - 0.5 ELSE yl END AS ylo, CASE WHEN yl = yh THEN yh + 0.5 ELSE yh END AS yhi FROM ext)
SELECT CAST(least(floor((x - xlo) * 20.0::DOUBLE / (xhi - xlo)), 19) AS INTEGER) AS bx,
       CAST(least(floor((y - ylo) * 20.0::DOUBLE / (yhi - ylo)), 19) AS INTEGER) AS by,
       l_returnflag, count(*) AS n
FROM s, e GROUP BY 1, 2, 3""",
)
def binned_scatter(spark, d):
    return D.binned_scatter(read_table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", group="l_returnflag")


PAIR_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


def _pair_sql() -> str:
    ext = ", ".join(
        f"min({c}) AS lo0_{c}, max({c}) AS hi0_{c}" for c in PAIR_COLS
    )
    edges = ", ".join(
        f"CASE WHEN lo0_{c} = hi0_{c} THEN lo0_{c} - 0.5 ELSE lo0_{c} END AS lo_{c}, "
        f"CASE WHEN lo0_{c} = hi0_{c} THEN hi0_{c} + 0.5 ELSE hi0_{c} END AS hi_{c}"
        for c in PAIR_COLS
    )
    parts = []
    for i, a in enumerate(PAIR_COLS):
        for b in PAIR_COLS[i + 1:]:
            bx = f"CAST(least(floor((CAST({a} AS DOUBLE) - lo_{a}) * 20.0::DOUBLE / (hi_{a} - lo_{a})), 19) AS INTEGER)"
            by = f"CAST(least(floor((CAST({b} AS DOUBLE) - lo_{b}) * 20.0::DOUBLE / (hi_{b} - lo_{b})), 19) AS INTEGER)"
            parts.append(
                f"SELECT '{a}' AS col_x, '{b}' AS col_y, {bx} AS bx, {by} AS by, count(*) AS n "
                f"FROM lineitem, e WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2, 3, 4"
            )
    return (f"WITH ext AS (SELECT {ext} FROM lineitem), e AS (SELECT {edges} FROM ext)\n"
            + "\nUNION ALL ".join(parts))


@register("pair_grid", _pair_sql())
def pair_grid(spark, d):
    return D.pair_binned_counts(read_table(spark, d, "lineitem"), PAIR_COLS, bins=20)

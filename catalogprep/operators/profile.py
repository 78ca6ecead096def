"""Counts, pivots, contingency tables, shares and top-N — long form first.

pandas drops NULL keys in ``value_counts`` / ``groupby`` / ``crosstab``;
these operators do the same explicitly.  The long form (``group_counts``) takes
any domain.  Wide (pivoted) output has a column per value: pass the values, or
they are read from the data, at most ``max_values`` of them (10,000 by default): a wider
domain raises, as it wants the long form.  Every aggregate is a hash aggregate with a map-side
partial step, so a hot key costs one partial row per task, not a hot task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalogprep.operators._common import bounded_domain


def _not_null(df: DataFrame, *cols: str) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def value_counts(df: DataFrame, column: str, *, count_col: str = "n", sort: str = "count") -> DataFrame:
    """Counts per non-null value; ordered by count desc (ties: value) or by
    value (``sort="value"``).  Ordering only matters at the presentation edge."""
    out = _not_null(df, column).groupBy(column).agg(F.count(F.lit(1)).alias(count_col))
    if sort == "count":
        return out.orderBy(F.desc(count_col), F.asc(column))
    if sort == "value":
        return out.orderBy(column)
    return out


def group_counts(df: DataFrame, *keys: str, count_col: str = "count") -> DataFrame:
    """``groupby(keys).size()`` in long form, NULL keys dropped."""
    return _not_null(df, *keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))


def _domain(df: DataFrame, column: str, values, max_values: int | None):
    return list(values) if values is not None else bounded_domain(df, column, max_values)


def pivot_counts(
    df: DataFrame,
    row: str,
    column: str,
    *,
    values=None,
    total_col: str | None = "total",
    max_values: int | None = None,
) -> DataFrame:
    """``groupby([row, column]).size().unstack().fillna(0)`` (+ row totals).

    One aggregate: a ``count_if`` per pivot value; the value list is taken
    from ``values`` or read from the data.
    """
    vals = _domain(df, column, values, max_values)
    src = _not_null(df, row, column)
    aggs = [F.count_if(F.col(column) == F.lit(v)).alias(str(v)) for v in vals]
    if total_col:
        aggs.append(F.count(F.lit(1)).alias(total_col))
    return src.groupBy(row).agg(*aggs)


def crosstab(df: DataFrame, row: str, column: str, *, values=None, max_values: int | None = None) -> DataFrame:
    """Contingency table (``pd.crosstab``): counts, missing cells 0, NULL
    keys dropped.  Unlike ``DataFrame.stat.crosstab`` nothing is collected."""
    return pivot_counts(df, row, column, values=values, total_col=None, max_values=max_values)


def pivot_sum(
    df: DataFrame,
    index: str,
    column: str,
    value: str,
    *,
    values=None,
    max_values: int | None = None,
    fill: float | int | None = 0,
) -> DataFrame:
    """Pivot a long table: ``pivot(index, columns, values).fillna(0)``."""
    vals = _domain(df, column, values, max_values)
    out = df.groupBy(index).pivot(column, vals).agg(F.sum(value))
    return out.na.fill(fill) if fill is not None else out


def row_share(df: DataFrame, row: str, column: str, *, count_col: str = "n", share_col: str = "share") -> DataFrame:
    """Row-normalised contingency table in long form: each cell's count over
    its row total.  The window runs over the aggregated cells only."""
    cells = group_counts(df, row, column, count_col=count_col)
    total = F.sum(count_col).over(Window.partitionBy(row))
    return cells.withColumn(share_col, F.col(count_col) / total)


def percent_share(df: DataFrame, column: str, *, count_col: str = "n", pct_col: str = "pct") -> DataFrame:
    """Counts per value and their percentage of all counted rows.  The grand
    total is the sum of the counts (a scalar subquery over the same aggregate,
    so the table is read once), not a window over one partition."""
    counts = value_counts(df, column, count_col=count_col, sort="none")
    total = counts.agg(F.sum(count_col)).scalar()
    return counts.withColumn(pct_col, F.col(count_col) * F.lit(100.0) / total)


def reindex(
    df: DataFrame,
    key: str,
    order: list,
    *,
    ord_col: str = "ord",
) -> DataFrame:
    """Align to a canonical category order (months, weekdays): every label
    appears once, a label absent from ``df`` gets NULL measures.  The label
    dimension is a small literal table; the planner picks the join."""
    spark = df.sparkSession
    dim = spark.createDataFrame(list(enumerate(order)), f"{ord_col} int, {key} string")
    return dim.join(df, key, "left")


def top_n(df: DataFrame, column: str, n: int, *, count_col: str = "n") -> DataFrame:
    """The ``n`` most frequent non-null values (ties broken by value):
    ``TakeOrderedAndProject`` keeps only ``n`` rows per task."""
    counts = value_counts(df, column, count_col=count_col, sort="none")
    return counts.orderBy(F.desc(count_col), F.asc(column)).limit(n)


def top_n_per_group(
    df: DataFrame,
    group: str,
    column: str,
    n: int,
    *,
    count_col: str = "n",
    rank_col: str = "rank",
) -> DataFrame:
    """Top ``n`` values per group by count (ties by value).  ``row_number``
    with a ``<= n`` filter lets Spark insert a partial per-group limit before
    the shuffle, so a huge group never ships all its candidate rows."""
    counts = group_counts(df, group, column, count_col=count_col)
    w = Window.partitionBy(group).orderBy(F.desc(count_col), F.asc(column))
    return counts.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def semi_filter_top(
    df: DataFrame,
    key: str,
    n: int,
    *,
    counts_from: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among the ``n`` most frequent keys.
    The top-n key set has a proven bound (``n`` rows) and is broadcast."""
    keys = top_n(counts_from if counts_from is not None else df, key, n).select(key)
    return df.join(F.broadcast(keys), key, "left_semi")


def outer_align(left: DataFrame, right: DataFrame, key: str, left_col: str, right_col: str) -> DataFrame:
    """Full-outer align two count lists on ``key``; missing counts -> 0."""
    j = left.join(right, key, "full_outer")
    return j.select(
        key,
        F.coalesce(F.col(left_col), F.lit(0)).alias(left_col),
        F.coalesce(F.col(right_col), F.lit(0)).alias(right_col),
    )


def recent_window(df: DataFrame, key: str, span: int) -> DataFrame:
    """Rows with ``key >= max(key) - span`` (max as a scalar subquery)."""
    hi = df.agg(F.max(key)).scalar()
    return df.where(F.col(key) >= hi - F.lit(span))


def label_threshold(df: DataFrame, total_col: str, threshold: float, *, flag_col: str = "labelled") -> DataFrame:
    """Flag rows whose total exceeds ``threshold`` (the chart-label rule)."""
    return df.withColumn(flag_col, F.col(total_col) > F.lit(threshold))

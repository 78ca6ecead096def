"""Summary statistics and correlation matrices (one aggregate pass each).

Quantiles are exact by default (linear interpolation, the same as numpy/pandas), by a
radix selection that gathers no group's values in one task (:func:`exact_quantiles`);
``exact=False`` takes ``percentile_approx`` (a bounded sketch) instead, in the same aggregate.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogprep.operators._common import parked

QUARTILES = (0.25, 0.5, 0.75)


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of a numeric type (pandas ``select_dtypes('number')``)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def quantiles(c: Column, probs=QUARTILES, *, exact: bool = True, accuracy: int = 10_000) -> Column:
    """Single-aggregate quantiles.  ``exact`` uses ``percentile``, whose state
    holds every distinct value of the group — use :func:`exact_quantiles`
    for high-cardinality columns at scale."""
    arr = F.array(*[F.lit(p) for p in probs])
    return F.percentile(c, arr) if exact else F.percentile_approx(c, arr, accuracy)


#: Counters of one pass per task and group, and the most rows of a cell whose values are ordered.
CELLS = 1 << 16
ORDERED_ROWS = 1 << 18
#: Cells per octave of the first pass: with all octaves of a double and both signs under ``CELLS``.
_PER_OCTAVE = 15


def _magnitude_cell(v: Column) -> Column:
    """A digit that grows with ``v``: its sign and its magnitude on a logarithmic scale, so
    that the spread of the values does not matter; infinities and NaN have digits of their own."""
    m = F.abs(v)
    digit = F.floor((F.log2(F.when((m > 0) & (m < float("inf")), m)) + 1075) * _PER_OCTAVE) + 1
    top = CELLS // 2
    return (F.when(F.isnan(v), top).when(v == float("inf"), top - 1).when(v == float("-inf"), 1 - top).when(v == 0, 0)
            .otherwise(F.when(v < 0, -digit).otherwise(digit)).cast("int"))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs=QUARTILES,
    groups: list[str] | tuple[str, ...] = (),
    *,
    ordered_rows: int = ORDERED_ROWS,
    few_groups: bool = False,
) -> DataFrame:
    """Exact quantiles (linear interpolation, as numpy / pandas / DuckDB's
    ``quantile_cont``) per group by radix selection, without gathering a group's
    values in one task.  Returns ``(groups..., n, p, q)`` (``n``: non-null values).

    1. One partial aggregate counts every group's rows by a first digit of the value, its
       sign and logarithm (under ``CELLS`` digits), with the smallest and largest value of each
       cell.  Running sums over a group's cells tell which cells hold the order statistics
       ``floor(p(n-1))`` and the next, and how many rows lie before them.
    2. While a wanted cell of several values has more than ``ordered_rows`` rows, the rows of such
       cells are counted again by an even digit between the cell's own extremes, ``CELLS`` to
       a cell.  Every pass divides a cell's width by ``CELLS``, so after three at most a cell
       holds one value; mostly one pass or none is needed.
    3. The values of the cells that are left are counted per distinct value and put in order.

    What a task sends is bounded by ``CELLS`` counters a group and pass, however many rows
    or splits there are; a very frequent value is one counter.  Every pass is written to the
    shared scratch folder (a few rows a group), and the next one is planned by it.  ``few_groups=True``
    says that the number of groups is bounded by construction (e.g. one per column), so the
    cells are broadcast; else the planner and AQE choose the join.  -0.0 equals 0.0; NaN counts
    as the largest value.
    """
    named = list(groups)
    src = df.select(*named, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    if not named:
        src, few_groups = src.withColumn("_all", F.lit(1)), True
    by = named or ["_all"]
    probs = [float(p) for p in probs]
    extremes = [F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]

    def wanted(ranks: Column) -> Column:
        return F.filter(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_c")))

    def running(keys: list[str], digit: str) -> Column:
        w = Window.partitionBy(*keys).orderBy(digit).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.sum("_c").over(w) - F.col("_c")

    bins = src.groupBy(*by, _magnitude_cell(F.col("_v")).alias("_d")).agg(*extremes)
    n = F.sum("_c").over(Window.partitionBy(*by))
    first = [F.floor(F.lit(p) * (F.col("_n") - 1)) for p in probs]
    ranks = F.array_distinct(F.array(*first, *[F.least(r + 1, F.col("_n") - 1) for r in first]))
    cells = (bins.withColumns({"_n": n, "_before": running(by, "_d")}).withColumn("_want", wanted(ranks))
             .where(F.size("_want") > 0).select(*by, "_n", "_lo", "_hi", "_c", "_before", "_want"))
    cells = parked(cells, "quantile-cells")

    def keyed(these: DataFrame, *cols) -> tuple[DataFrame, list[Column]]:
        """Cells under other names, with the condition that joins them to rows of their group."""
        side = these.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], F.col("_lo").alias("_cell0"), *cols)
        return (F.broadcast(side) if few_groups else side), [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)]

    def inside(these: DataFrame) -> DataFrame:
        """Rows of ``src`` beside their cell: its smallest (which names it, as the cells of a group
        are disjoint) and largest value."""
        side, same = keyed(these, "_hi")
        return src.join(side, [*same, F.col("_v") >= F.col("_cell0"), F.col("_v") <= F.col("_hi")]).select(
            *by, "_v", F.col("_cell0").alias("_cell"), "_hi")

    def beside(rows: DataFrame, these: DataFrame) -> DataFrame:
        """``rows`` of a cell beside the number of rows before it and the ranks wanted in it."""
        side, same = keyed(these, "_n", "_before", "_want")
        return rows.join(side, [*same, F.col("_cell") == F.col("_cell0")])

    wide = (F.col("_c") > ordered_rows) & (F.col("_lo") < F.col("_hi"))
    while not cells.where(wide).isEmpty():
        large = cells.where(wide)
        digit = F.floor((F.col("_v") - F.col("_cell")) / (F.col("_hi") - F.col("_cell")) * CELLS)
        parts = inside(large).withColumn("_d", F.least(digit, F.lit(CELLS - 1)).cast("int")).groupBy(*by, "_cell", "_d").agg(*extremes)
        finer = (beside(parts.withColumn("_inner", running([*by, "_cell"], "_d")), large)
                 .withColumn("_before", F.col("_before") + F.col("_inner")).withColumn("_want", wanted(F.col("_want")))
                 .where(F.size("_want") > 0).select(*cells.columns))
        cells = parked(cells.where(~wide).unionByName(finer), "quantile-cells")

    known = cells.where("_lo = _hi").select(*by, "_n", F.explode("_want").alias("_r"), F.col("_lo").alias("_x"))
    several = cells.where("_lo < _hi")
    counts = inside(several).groupBy(*by, "_cell", F.col("_v").alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    placed = (beside(counts.withColumn("_inner", running([*by, "_cell"], "_x")), several)
              .withColumn("_before", F.col("_before") + F.col("_inner")))
    found = placed.select(*by, "_n", "_x", F.explode(wanted(F.col("_want"))).alias("_r"))
    values = F.map_from_entries(F.collect_list(F.struct("_r", "_x")))  # two ranks a probability at most
    each = known.unionByName(found.select(*known.columns)).groupBy(*by, "_n").agg(values.alias("_at"))
    each = each.select(*named, F.col("_n").alias("n"), "_at", F.explode(F.array(*map(F.lit, probs))).alias("p"))
    rank = F.floor(F.col("p") * (F.col("n") - 1))
    frac = F.col("p") * (F.col("n") - 1) - rank
    lo, hi = F.element_at("_at", rank), F.element_at("_at", F.least(rank + 1, F.col("n") - 1))
    return each.select(*named, "n", "p", F.when(frac == 0, lo).otherwise(lo + frac * (hi - lo)).alias("q"))


def quantile_columns(qs: DataFrame, groups: list[str] | tuple[str, ...], names: dict[float, str]) -> DataFrame:
    """Long ``(groups..., n, p, q)`` -> ``(groups..., n, <one column per probability>)``."""
    return qs.groupBy(*groups, "n").agg(
        *[F.max(F.when(F.col("p") == F.lit(float(p)), F.col("q"))).alias(n) for p, n in names.items()]
    )


def describe_numeric(
    df: DataFrame,
    columns: list[str] | None = None,
    *,
    exact: bool = True,
    decimals: int | None = None,
) -> DataFrame:
    """pandas ``describe()``: per numeric column ``count, mean, std`` (sample),
    ``min, p25, p50, p75, max`` — all columns in one aggregate, then one row
    per column.  ``decimals`` rounds the double statistics."""
    cols = list(columns or numeric_columns(df))
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        fields = [F.lit(c).alias("column_name"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                  F.stddev_samp(x).alias("std"), F.min(x).alias("min")]
        if not exact:
            q = quantiles(x, exact=False)
            fields += [q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75")]
        aggs.append(F.struct(*fields, F.max(x).alias("max")).alias(f"s{i}"))
    wide = df.agg(*aggs)
    out = wide.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s")).select("s.*")
    if exact:
        # quartiles of all columns at once: stack to (column_name, value)
        stacked = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_x")) for c in cols
        ])).alias("_s")).select("_s.*")
        qs = quantile_columns(
            exact_quantiles(stacked, "_x", QUARTILES, ["column_name"], few_groups=True), ["column_name"],
            {0.25: "p25", 0.5: "p50", 0.75: "p75"},
        )
        # one row per column on both sides: bounded by the schema
        out = out.join(F.broadcast(qs.drop("n")), "column_name", "left").select(
            "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
        )
    if decimals is not None:
        out = out.withColumns(
            {k: F.round(k, decimals) for k in ("mean", "std", "min", "p25", "p50", "p75", "max")}
        )
    return out


def describe_categorical(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``count, unique, top, freq`` per non-numeric column, in one pass: the
    columns are stacked into (column, value) pairs, counted with a partial
    aggregate, and the top value per column picked by ``row_number``."""
    cols = list(columns or [c for c in df.columns if c not in numeric_columns(df)])
    pairs = df.select(
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols
        ])).alias("p")
    ).select("p.*").where(F.col("value").isNotNull())
    counts = pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("freq"))
    # top value = highest count, ties to the smallest value; a min over
    # structs is a partial aggregate, so a key-like column with billions of
    # distinct values never lands in one task.
    best = F.min(F.struct((-F.col("freq")).alias("nf"), F.col("value").alias("v")))
    per_col = counts.groupBy("column_name").agg(
        F.sum("freq").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("_b")
    )
    return per_col.select(
        "column_name", "count", "unique", F.col("_b.v").alias("top"), (-F.col("_b.nf")).alias("freq")
    )


def describe_all(df: DataFrame, *, exact: bool = True, decimals: int | None = None) -> DataFrame:
    """pandas ``describe(include='all')`` in long form: one row per column
    with ``count, unique, top, freq, mean, std, min, p25, p50, p75, max``
    (categorical statistics NULL for numeric columns and vice versa)."""
    nums = numeric_columns(df)
    cats = [c for c in df.columns if c not in nums]
    parts = []
    if nums:
        n = describe_numeric(df, nums, exact=exact, decimals=decimals)
        parts.append(n.select(
            "column_name", "count", F.lit(None).cast("bigint").alias("unique"),
            F.lit(None).cast("string").alias("top"), F.lit(None).cast("bigint").alias("freq"),
            "mean", "std", "min", "p25", "p50", "p75", "max",
        ))
    if cats:
        c = describe_categorical(df, cats)
        nul = F.lit(None).cast("double")
        parts.append(c.select(
            "column_name", "count", "unique", "top", "freq",
            *[nul.alias(k) for k in ("mean", "std", "min", "p25", "p50", "p75", "max")],
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _gram(df: DataFrame, entries: list[Column]) -> np.ndarray:
    """Sums over all rows of the products of every two ``entries``: each task adds its rows to one
    triangle of numbers, triangles are added in a tree, and the driver gets the last one."""
    rows = MLUtils.convertVectorColumnsFromML(df.select(array_to_vector(F.array(*entries)).alias("v")))
    return RowMatrix(rows, numCols=len(entries)).computeGramianMatrix().toArray()


#: A variance below this share of the mean square is rounding: the column is constant there.
CONSTANT = 1e-12


def co_moments(df: DataFrame, columns: list[str], *, masked: bool = True) -> tuple[np.ndarray, ...]:
    """``(n, cov, var)`` as square arrays over ``columns``: for each pair the rows in which both are
    present, their population covariance, and the variance of the first in these rows.

    One pass centres the columns, the next one adds up one block of cross-products per task, over
    the values, their squares and, if ``masked``, whether they are present: entries of that block
    are all a pair needs, however many pairs there are.  Without ``masked`` no value may be missing."""
    k = len(columns)
    rows, *means = df.agg(F.count(F.lit(1)), *[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    if not rows:
        return tuple(np.zeros((k, k)) for _ in range(3))
    x = [F.col(f"`{c}`") - F.lit(float(m or 0.0)) for c, m in zip(columns, means)]
    zero = F.lit(0.0)
    if masked:
        entries = [F.coalesce(v, zero) for v in x] + [F.coalesce(v * v, zero) for v in x] + [F.when(v.isNull(), 0.0).otherwise(1.0) for v in x]
        g = _gram(df, entries)
        n, s, q, xy = g[2 * k:, 2 * k:], g[:k, 2 * k:], g[k:2 * k, 2 * k:], g[:k, :k]
    else:
        g = _gram(df, [*x, F.lit(1.0)])
        n = np.full((k, k), g[k, k])
        s, q, xy = np.repeat(g[:k, k:], k, axis=1), np.repeat(np.diag(g)[:k, None], k, axis=1), g[:k, :k]
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = xy / n - (s / n) * (s.T / n)
        var = q / n - (s / n) ** 2
        var = np.where(var > CONSTANT * q / n, var, 0.0)
    return n, cov, var


def corr_matrix(
    df: DataFrame,
    columns: list[str] | None = None,
    *,
    missing: str = "pairwise",
    decimals: int | None = None,
) -> DataFrame:
    """Correlation matrix in long form ``(col_a, col_b, corr)``, both
    triangles and the diagonal, from two passes over the rows (see :func:`co_moments`); the
    result has a row per pair of columns.  NULL where a side is constant or no row is left;
    NaN is a missing value, as in pandas.

    ``missing``: ``"pairwise"`` (each pair over rows where both are present,
    pandas ``corr()``), ``"listwise"`` (rows with any missing value dropped
    first, ``dropna().corr()``), ``"zero_fill"`` (``fillna(0).corr()``).
    """
    cols = list(columns or numeric_columns(df))
    value = lambda c: F.col(f"`{c}`").cast("double")
    src = df.select(*[F.when(~F.isnan(value(c)), value(c)).alias(c) for c in cols])
    if missing == "listwise":
        src = src.na.drop(how="any")
    elif missing == "zero_fill":
        src = src.na.fill(0.0)
    elif missing != "pairwise":
        raise ValueError(f"unknown missing-value policy {missing!r}")
    n, cov, var = co_moments(src, cols, masked=missing == "pairwise")
    with np.errstate(divide="ignore", invalid="ignore"):
        r = cov / np.sqrt(var * var.T)
    defined = (n > 0) & (var > 0) & (var.T > 0)
    rows = [(a, b, float(r[i, j]) if defined[i, j] else None) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    out = df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")
    return out.withColumn("corr", F.round("corr", decimals)) if decimals is not None else out

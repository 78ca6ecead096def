"""Distributions behind the charts: histograms, kernel density, box plots,
binned scatter.  Global extremes come from one aggregate (a scalar
subquery); rows are then binned and counted with a partial aggregate, so
the output is bounded by the number of bins, not by the data."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogprep.operators.stats import QUARTILES, exact_quantiles, quantile_columns, quantiles


def _edges(df: DataFrame, column: str) -> tuple[Column, Column]:
    """numpy's histogram range: [min, max], widened by 0.5 when min == max."""
    ext = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    lo = ext.select(F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo"))).scalar()
    hi = ext.select(F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi"))).scalar()
    return lo, hi


def bin_index(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1; the top edge falls in the last bin."""
    raw = F.floor((x - lo) * F.lit(float(bins)) / (hi - lo))
    return F.least(raw, F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """``(bin, bin_lo, bin_hi, n)`` for every bin, empty bins included."""
    src = df.where(F.col(column).isNotNull())
    lo, hi = _edges(src, column)
    x = F.col(column).cast("double")
    counts = src.select(bin_index(x, lo, hi, bins).alias("bin")).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n")
    )
    spark = df.sparkSession
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / F.lit(float(bins))
    # both sides have at most ``bins`` rows; the planner picks the join
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_lo"),
        (lo + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n"),
    )


#: Cells of a bandwidth, moments kept of each, and the distance, in bandwidths, up to which a
#: cell adds to the density.
KDE_CELLS, KDE_MOMENTS, KDE_REACH = 8, 8, 8.5


def kde_error_bound(cells: int = KDE_CELLS, moments: int = KDE_MOMENTS, reach: float = KDE_REACH) -> float:
    """Largest error of the binned density, as a share of the kernel's peak: the first term left
    out of the expansion around a cell's middle, and the kernel beyond the reach.  The K-th
    derivative of ``exp(-z^2/2)`` is at most ``K! / (2^(K/2) (K/2)!)`` for even K."""
    half = moments // 2
    return (0.5 / cells) ** moments / (2 ** half * math.factorial(half)) + math.exp(-0.5 * reach * reach)


def _binned_kernel_sums(src: DataFrame, points: int, bw: Column, lo: Column, g_lo: Column, step: Column) -> DataFrame:
    """``(i, _s)``: kernel sums at the grid points near any value, from the moments of cells.

    Rows are aggregated to cells of a fraction of the bandwidth: a cell keeps the sums of
    its values' distances from its middle, to the powers 0, 1, 2, ...  Around the middle the kernel is a
    series in that distance with Hermite polynomials as coefficients, so the sums are all that
    a grid point needs.  No row is repeated; cells times grid points within reach are."""
    rows = src.select("v", F.nullif(bw, F.lit(0.0)).alias("bw"), lo.alias("lo"), g_lo.alias("g_lo"), step.alias("step"))
    cell = F.floor((F.col("v") - F.col("lo")) * KDE_CELLS / F.col("bw"))
    placed = rows.where("bw IS NOT NULL").withColumn("cell", cell).withColumn("mid", F.col("lo") + (F.col("cell") + 0.5) * F.col("bw") / KDE_CELLS)
    d, power, sums = (F.col("v") - F.col("mid")) / F.col("bw"), F.lit(1.0), []
    for k in range(KDE_MOMENTS):
        sums.append((F.sum(power) / math.factorial(k)).alias(f"m{k}"))
        power = power * F.col("d")
    # the statistics are the same in every row: any of them will do
    cells = placed.withColumn("d", d).groupBy("cell").agg(*sums, *[F.any_value(c).alias(c) for c in ("mid", "bw", "g_lo", "step")])
    first = F.greatest(F.ceil((F.col("mid") - KDE_REACH * F.col("bw") - F.col("g_lo")) / F.col("step")), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("mid") + KDE_REACH * F.col("bw") - F.col("g_lo")) / F.col("step")), F.lit(points - 1)).cast("int")
    near = cells.select("*", F.explode(F.when(first <= last, F.sequence(first, last))).alias("i"))
    near = near.withColumn("z", (F.col("g_lo") + F.col("i") * F.col("step") - F.col("mid")) / F.col("bw"))
    z, polynomial, before, total = F.col("z"), F.lit(1.0), F.lit(0.0), F.lit(0.0)
    for k in range(KDE_MOMENTS):
        near = near.withColumn(f"h{k}", polynomial)
        total = total + F.col(f"h{k}") * F.col(f"m{k}")
        polynomial, before = z * F.col(f"h{k}") - k * before, F.col(f"h{k}")
    return near.groupBy("i").agg(F.sum(F.exp(F.lit(-0.5) * z * z) * total).alias("_s"))


def _exact_kernel_sums(src: DataFrame, points: int, bw: Column, g_lo: Column, step: Column) -> DataFrame:
    rows = src.select("v", F.nullif(bw, F.lit(0.0)).alias("bw"), g_lo.alias("g_lo"), step.alias("step"))
    each = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    z = (F.col("g_lo") + F.col("i") * F.col("step") - F.col("v")) / F.col("bw")
    return each.groupBy("i").agg(F.sum(F.exp(F.lit(-0.5) * z * z)).alias("_s"))


def kde_grid(
    df: DataFrame,
    column: str,
    *,
    points: int = 200,
    cut: float = 3.0,
    exact: bool = False,
) -> DataFrame:
    """Gaussian kernel density on an even grid, ``(i, x, density)``.

    Bandwidth is Scott's rule (``std * n ** -0.2``, sample std); the grid
    spans ``[min - cut*bw, max + cut*bw]``.  The density is computed from the moments of cells
    of an eighth of the bandwidth, one partial aggregate over the rows, with an error
    of at most :func:`kde_error_bound` (below 1e-12) times the kernel's peak; ``exact=True`` evaluates
    every row at every grid point instead.  A constant or one-row column has no bandwidth: its grid
    points all lie at the value and their density is NULL; an empty column
    gives no rows.
    """
    src = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    st = src.agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    n = st.select("n").scalar()
    bw = st.select(F.coalesce(F.col("sd"), F.lit(0.0)) * F.pow(F.col("n").cast("double"), F.lit(-0.2))).scalar()
    lo = st.select("lo").scalar()
    hi = st.select("hi").scalar()
    g_lo, step = lo - F.lit(cut) * bw, (hi - lo + F.lit(2 * cut) * bw) / F.lit(float(points - 1))
    sums = _exact_kernel_sums(src, points, bw, g_lo, step) if exact else _binned_kernel_sums(src, points, bw, lo, g_lo, step)
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("i")).where(n > 0)
    norm = n * bw * F.lit(math.sqrt(2.0 * math.pi))
    # both sides have at most ``points`` rows; the planner picks the join
    return grid.join(sums, "i", "left").select(
        "i", (g_lo + F.col("i") * step).alias("x"), F.try_divide(F.coalesce("_s", F.lit(0.0)), norm).alias("density")
    )


def boxplot_stats(df: DataFrame, group: str, column: str, *, exact: bool = True, whisker: float = 1.5) -> DataFrame:
    """Per group: ``n, q1, median, q3, whisker_lo, whisker_hi, n_outliers``
    (matplotlib's rule: whiskers at the most extreme values within
    ``whisker * IQR`` of the quartiles): the quartiles, then one aggregate over
    the rows beside their group's fences."""
    src = df.where(F.col(group).isNotNull() & F.col(column).isNotNull()).select(
        group, F.col(column).cast("double").alias("v")
    )
    if exact:
        qs = quantile_columns(exact_quantiles(src, "v", QUARTILES, [group]), [group],
                              {0.25: "q1", 0.5: "median", 0.75: "q3"})
    else:
        q = quantiles(F.col("v"), exact=False)
        qs = src.groupBy(group).agg(
            F.count(F.lit(1)).alias("n"), q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3")
        )
    fences = qs.select(
        "*",
        (F.col("q1") - F.lit(whisker) * (F.col("q3") - F.col("q1"))).alias("_lo"),
        (F.col("q3") + F.lit(whisker) * (F.col("q3") - F.col("q1"))).alias("_hi"),
    )
    # one row per group; the planner and AQE choose the join
    j = src.join(fences, group)
    inside = (F.col("v") >= F.col("_lo")) & (F.col("v") <= F.col("_hi"))
    return j.groupBy(group, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"),
    )


def binned_scatter(
    df: DataFrame, x: str, y: str, *, bins_x: int = 20, bins_y: int = 20, group: str | None = None
) -> DataFrame:
    """A scatter plot as counts on a ``bins_x x bins_y`` grid (optionally per
    colour group): ``(bx, by[, group], n)``, non-empty cells only."""
    keep = F.col(x).isNotNull() & F.col(y).isNotNull()
    if group:
        keep = keep & F.col(group).isNotNull()
    src = df.where(keep)
    xlo, xhi = _edges(src, x)
    ylo, yhi = _edges(src, y)
    keys = [
        bin_index(F.col(x).cast("double"), xlo, xhi, bins_x).alias("bx"),
        bin_index(F.col(y).cast("double"), ylo, yhi, bins_y).alias("by"),
    ]
    if group:
        keys.append(F.col(group))
    return src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def pair_binned_counts(df: DataFrame, columns: list[str], *, bins: int = 20) -> DataFrame:
    """All-pairs relations (a pair plot's off-diagonal panels) as binned
    counts ``(col_x, col_y, bx, by, n)`` for every unordered column pair, in
    one scan: each row emits one cell per pair (a fixed number per row) and
    a partial aggregate counts cells.  Rows missing either value of a pair
    are left out of that pair only."""
    # min and max leave nulls out by themselves: the same unfiltered input for
    # every column lets the planner merge all extremes into one aggregate
    lo_hi = {c: _edges(df, c) for c in columns}
    cells = []
    for i, a in enumerate(columns):
        for b in columns[i + 1:]:
            (alo, ahi), (blo, bhi) = lo_hi[a], lo_hi[b]
            ok = F.col(a).isNotNull() & F.col(b).isNotNull()
            cells.append(F.struct(
                ok.alias("ok"), F.lit(a).alias("col_x"), F.lit(b).alias("col_y"),
                bin_index(F.col(a).cast("double"), alo, ahi, bins).alias("bx"),
                bin_index(F.col(b).cast("double"), blo, bhi, bins).alias("by"),
            ))
    ex = df.select(F.explode(F.array(*cells)).alias("c")).where(F.col("c.ok")).select("c.col_x", "c.col_y", "c.bx", "c.by")
    return ex.groupBy("col_x", "col_y", "bx", "by").agg(F.count(F.lit(1)).alias("n"))

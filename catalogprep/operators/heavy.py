"""Top-N without shuffling every key: mergeable heavy-hitter summaries, an exact recount of
their candidates, and a certificate.

1. Every task keeps a bounded summary of its rows' keys (Spark's frequent-items sketch); the
   summaries are merged in two steps, so no task merges those of all tasks.
2. The summary's candidates are counted exactly in a second scan, beside which a small
   table is broadcast; only they are shuffled.
3. A key that is no candidate occurs at most ``bound`` times: twice the sketch's largest error,
   and no more than the last candidate's estimate where the list is full.  If the N-th exact
   count is above ``bound``, or the candidates are all the keys there are, nothing can be
   missing, and the recount is the answer.
4. Where that does not hold (flat distributions), all keys are counted; with groups, only
   those of the groups concerned.

Both ways give the same rows: N keys by count, ties by key.  A summary pays where keys are many
and the top ones frequent (words, hosts, users); for few keys a plain count is as good.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalogprep.operators._common import parked

#: Keys that a summary tracks, and how many tables of partial summaries there are per group.
TRACKED = 10_000
MERGERS = 64


def summary_error(tracked: int) -> float:
    """The sketch's largest error as a share of the rows: 3.5 by the slots of its table, the
    next power of two that is at most three quarters full."""
    slots = 1
    while slots * 0.75 < tracked:
        slots *= 2
    return 3.5 / slots


def candidates(src: DataFrame, column: str, groups: list[str], tracked: int = TRACKED, mergers: int = MERGERS) -> DataFrame:
    """``(groups..., column, rows, bound)``: the keys that a summary of each group tracks for
    certain, beside its number of rows and the bound on all other keys."""
    part = F.pmod(F.spark_partition_id(), F.lit(mergers)).alias("_part")
    some = src.select(*groups, F.col(column).alias("_key"), part).groupBy(*groups, "_part").agg(
        F.expr(f"approx_top_k_accumulate(_key, {int(tracked)})").alias("_state"), F.count(F.lit(1)).alias("_rows"))
    whole = some.groupBy(*groups).agg(
        F.expr(f"approx_top_k_combine(_state, {int(tracked)})").alias("_state"), F.sum("_rows").alias("rows"))
    listed = whole.select(*groups, "rows", F.expr(f"approx_top_k_estimate(_state, {int(tracked)})").alias("_e")).where("rows > 0")
    last = F.when(F.size("_e") >= tracked, F.element_at("_e", -1)["count"]).otherwise(0)
    bound = F.greatest(F.ceil(F.lit(2 * summary_error(tracked)) * F.col("rows")), last)
    # outer: a group without a candidate has to be counted
    return listed.select(*groups, "rows", bound.alias("bound"), F.explode_outer("_e").alias("_i")).select(
        *groups, F.col("_i.item").alias(column), "rows", "bound")


def top_n_by_summary(
    df: DataFrame,
    column: str,
    n: int,
    *,
    groups: list[str] | tuple[str, ...] = (),
    count_col: str = "n",
    rank_col: str = "rank",
    tracked: int = TRACKED,
    mergers: int = MERGERS,
) -> DataFrame:
    """``(groups..., column, n, rank)``: the ``n`` most frequent non-null keys, per group if
    ``groups`` are given (NULL groups left out), ties by key.  The summary's candidates (at most
    ``tracked`` per group) and their exact counts are written to the shared scratch folder."""
    named = list(groups)
    src = df.select(*named, column)
    for c in (*named, column):
        src = src.where(F.col(c).isNotNull())
    by = named or ["_all"]
    if not named:
        src = src.withColumn("_all", F.lit(1))
    found = parked(candidates(src, column, by, tracked, mergers), "candidates")
    # without groups the candidates are ``tracked`` at most; with groups the planner looks at their size
    side = found.select(*by, column)
    counts = src.join(side if named else F.broadcast(side), [*by, column], "left_semi").groupBy(*by, column).agg(F.count(F.lit(1)).alias(count_col))
    counts = parked(counts, "recount")
    order = Window.partitionBy(*by).orderBy(F.desc(count_col), F.asc(column))
    ranked = counts.withColumn(rank_col, F.row_number().over(order)).where(F.col(rank_col) <= n)
    bounds = found.groupBy(*by).agg(F.max("rows").alias("rows"), F.max("bound").alias("bound"))
    least = ranked.groupBy(*by).agg(F.min(F.when(F.col(rank_col) == n, F.col(count_col))).alias("least"))
    covered = counts.groupBy(*by).agg(F.sum(count_col).alias("covered"))
    sure = bounds.join(least, by, "left").join(covered, by, "left").select(
        *by, F.coalesce((F.col("least") > F.col("bound")) | (F.col("covered") == F.col("rows")), F.lit(False)).alias("sure"))
    sure = parked(sure, "certificates")
    if sure.where(~F.col("sure")).isEmpty():
        return ranked.select(*named, column, count_col, rank_col)
    open_groups = sure.where(~F.col("sure")).select(*by)
    every = src.join(open_groups, by, "left_semi") if named else src
    full = every.groupBy(*by, column).agg(F.count(F.lit(1)).alias(count_col))
    full = full.withColumn(rank_col, F.row_number().over(order)).where(F.col(rank_col) <= n)
    kept = ranked.join(open_groups, by, "left_anti")
    return kept.unionByName(full).select(*named, column, count_col, rank_col)

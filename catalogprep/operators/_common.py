"""Small shared helpers for operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogprep.session import scratch_path


def parked(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: what several later steps use
    is computed once, and a lost executor costs no recomputation of what lies before."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def require_columns(df: DataFrame, columns) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"unknown column(s) {missing}; available: {df.columns}")


#: The most columns that one attribute becomes in wide output, and the most values of it
#: that the driver reads.  Wider attributes have long and sparse forms.
MAX_WIDE = 10_000


def bounded_domain(df: DataFrame, column: str, max_values: int | None = None) -> list:
    """Sorted distinct non-null values of ``column``: the columns of a pivot or
    a one-hot table, which the driver must know.  At most ``max_values`` + 1 are read
    (``MAX_WIDE`` by default); a wider domain raises, the long-form operators need none."""
    most = MAX_WIDE if max_values is None else max_values
    vals = df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column).limit(most + 1).collect()
    if len(vals) > most:
        raise ValueError(
            f"column {column!r} has more than {most} distinct values; "
            "use the long or sparse form instead of a wide one"
        )
    return [r[0] for r in vals]


#: Tables above this size are never spread: their splits are the parallelism.
SPREAD_MAX_BYTES = 2 << 30


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread the rows of a **small** scan over the cores when its file has
    fewer splits than cores (e.g. one Parquet row group of some megabytes),
    before CPU-heavy per-row work such as tokenising texts.  With ``keys`` the
    rows are hash-partitioned on them, so later aggregates reuse it.  Scans of
    over ``SPREAD_MAX_BYTES`` (the planner's file-size estimate) and scans with
    enough splits are returned unchanged: a large table is never shuffled.

    Call it on a table scan (the query plans do); operators never call it."""
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > SPREAD_MAX_BYTES:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys) if keys else df.repartition(cores)

"""Data quality: null profiles, fills, drops, dedupe, schema report.

The reference profiles nulls with one job per column (two profiles over 12
columns = 24 jobs).  Here a profile is one aggregate pass: ``count_if`` per
column in a single ``agg``, then one row per column from that one-row result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from catalogprep.operators._common import require_columns


def _per_column(wide: DataFrame, kept: list[str], entries: list) -> DataFrame:
    """One row per profiled column from a one-row aggregate: the position and the
    fields of each entry (a struct), exploded together, so that no expression has to
    cut a position out of a name."""
    return wide.select(*kept, F.posexplode(F.array(*entries)).alias("position", "e")).select("position", "e.*", *kept)


def _pct(n, total):
    return F.try_divide(n * F.lit(100.0), total)


def null_profile(df: DataFrame, columns: list[str] | None = None, *, decimals: int | None = None) -> DataFrame:
    """One row per column: ``position, column_name, null_count, null_pct,
    total_rows`` — all columns in one scan.  ``null_pct`` is NULL on an
    empty table (no division by zero); ``decimals`` rounds it for display."""
    cols = list(columns or df.columns)
    require_columns(df, cols)
    wide = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)],
    )
    long = _per_column(wide, ["total_rows"], [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count")) for i, c in enumerate(cols)
    ])
    pct = _pct(F.col("null_count"), F.col("total_rows"))
    return long.select(
        "position",
        "column_name",
        "null_count",
        (F.round(pct, decimals) if decimals is not None else pct).alias("null_pct"),
        "total_rows",
    )


def _fill_metrics(cols: list[str], fill: dict[str, object]) -> list[Column]:
    """The aggregates of a fill profile: rows, rows without a null after filling, nulls by column."""
    complete = F.lit(True)
    for c in cols:
        if c not in fill:
            complete = complete & F.col(c).isNotNull()
    return [F.count(F.lit(1)).alias("total_rows"), F.count_if(complete).alias("rows_after_drop"),
            *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]]


def _fill_report(wide: DataFrame, cols: list[str], fill: dict[str, object]) -> DataFrame:
    """One row per column from the one row of ``_fill_metrics``."""
    long = _per_column(wide, ["total_rows", "rows_after_drop"], [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"),
                 (F.lit(0).cast("bigint") if c in fill else F.col(f"n{i}")).alias("nulls_after_fill"))
        for i, c in enumerate(cols)
    ])
    return long.select(
        "position",
        "column_name",
        "null_count",
        _pct(F.col("null_count"), F.col("total_rows")).alias("null_pct"),
        "nulls_after_fill",
        _pct(F.col("nulls_after_fill"), F.col("total_rows")).alias("pct_after_fill"),
        "total_rows",
        "rows_after_drop",
    )


def fill_profile(df: DataFrame, fill: dict[str, object], columns: list[str] | None = None) -> DataFrame:
    """Null profile before **and** after filling, plus the row count left
    after dropping rows that still hold a null — still one scan.

    Columns: ``position, column_name, null_count, null_pct, nulls_after_fill,
    pct_after_fill, total_rows, rows_after_drop``.
    """
    cols = list(columns or df.columns)
    require_columns(df, cols)
    require_columns(df, fill.keys())
    return _fill_report(df.agg(*_fill_metrics(cols, fill)), cols, fill)


class ObservedFillProfile:
    """A :func:`fill_profile` that costs no scan: its counts are observed while some action
    runs over ``watched`` (the input, to be used in its place)."""

    def __init__(self, df: DataFrame, fill: dict[str, object]):
        require_columns(df, fill.keys())
        self._spark, self._cols, self._fill = df.sparkSession, df.columns, fill
        self._seen = Observation(f"fill-profile-{uuid.uuid4().hex}")
        self.watched = df.observe(self._seen, *_fill_metrics(self._cols, fill))

    def frame(self) -> DataFrame:
        """The profile, once an action has run over the whole of ``watched`` (waits for its end)."""
        names = ["total_rows", "rows_after_drop", *(f"n{i}" for i in range(len(self._cols)))]
        counts = self._seen.get
        wide = self._spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} bigint" for n in names))
        return _fill_report(wide, self._cols, self._fill)


def missing_report(df: DataFrame, top: int = 10, columns: list[str] | None = None) -> DataFrame:
    """Columns sorted by missing count (desc, then name), first ``top``."""
    prof = null_profile(df, columns)
    return (
        prof.select("column_name", "null_count", "null_pct")
        .orderBy(F.desc("null_count"), F.asc("column_name"))
        .limit(top)
    )


def fill_nulls(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Per-column null fill; an unknown column is an error (not ignored)."""
    require_columns(df, values.keys())
    return df.na.fill(values)


def drop_null_rows(df: DataFrame, subset: list[str] | None = None, how: str = "any") -> DataFrame:
    if subset:
        require_columns(df, subset)
    return df.na.drop(how=how, subset=subset)


def clean_nulls(df: DataFrame, fill: dict[str, object]) -> tuple[DataFrame, DataFrame]:
    """Fill, then drop rows that still hold a null.  Returns the cleaned
    DataFrame and its one-pass :func:`fill_profile` (both lazy)."""
    return drop_null_rows(fill_nulls(df, fill)), fill_profile(df, fill)


def dedupe(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Full-row (or subset) de-duplication; array columns are valid keys.
    Partial aggregation removes duplicates map-side before the shuffle."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def shape(df: DataFrame) -> DataFrame:
    """``(n_rows, n_columns)`` as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: ``position, column_name, data_type,
    non_null_count`` — types from the schema, counts in one pass."""
    fields = df.schema.fields
    wide = df.agg(*[F.count(F.col(f.name)).alias(f"n{i}") for i, f in enumerate(fields)])
    return _per_column(wide, [], [
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.col(f"n{i}").alias("non_null_count")) for i, f in enumerate(fields)
    ])


def preview(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows in a deterministic order (``TakeOrderedAndProject``)."""
    keys = order_by or df.columns[:1]
    return df.orderBy(*keys).limit(n)

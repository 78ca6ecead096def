"""Sinks: Parquet (overwrite, read-back), lookup files in both published shapes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _norm(path: str) -> str:
    from urllib.parse import urlparse

    u = urlparse(path)
    if u.scheme in ("", "file"):
        import os

        return os.path.normpath(u.path or path)
    return path.rstrip("/")


def _refuse_self_overwrite(df: DataFrame, path: str) -> None:
    target = _norm(path)
    for f in df.inputFiles():
        src = _norm(f)
        if src == target or src.startswith(target + "/"):
            raise ValueError(f"refusing to overwrite {path!r}: the DataFrame reads from it")


class IncompleteWrite(RuntimeError):
    """What can be read back is not what was written."""


def _types(df: DataFrame, names: set[str]) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name in names}


def check_written(df: DataFrame, back: DataFrame, rows: int, partition_by: list[str] | None = None) -> None:
    """Raise :class:`IncompleteWrite` unless ``back`` has ``rows`` rows, by its files' footers (a
    count reads no column), and the columns and types of ``df`` (a folder's partition
    columns come back by name only)."""
    names = set(df.columns)
    if set(back.columns) != names or _types(df, names - set(partition_by or ())) != _types(back, names - set(partition_by or ())):
        raise IncompleteWrite(f"written as {df.schema.simpleString()}, read back as {back.schema.simpleString()}")
    found = back.count()
    if found != rows:
        raise IncompleteWrite(f"{rows} rows were written, {found} can be read back")


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    verify: bool = True,
) -> DataFrame:
    """Write Parquet and return the read-back DataFrame (lazy).

    The write goes through Spark's commit protocol, so a lost executor only
    re-runs its tasks.  Overwriting a path the DataFrame reads from is refused.
    With ``verify`` the rows are counted while they are written, and rows and schema
    are compared with the files (see :func:`check_written`); ``append`` counts the
    rows that were there, and a dynamic partition overwrite is not compared.
    """
    spark = df.sparkSession
    if mode == "overwrite":
        _refuse_self_overwrite(df, path)
    dynamic = bool(partition_by) and spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static").lower() == "dynamic"
    verify = verify and not (dynamic and mode == "overwrite")
    before = 0
    if verify and mode == "append" and _exists(spark, path):
        before = spark.read.parquet(path).count()
    seen = Observation(f"rows-written-{uuid.uuid4().hex}")
    out = df.observe(seen, F.count(F.lit(1)).alias("rows")) if verify else df
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # a folder without a data file (no rows, partitioned) has no schema of its own
    empty = verify and seen.get["rows"] + before == 0
    back = spark.read.schema(df.schema).parquet(path) if empty else spark.read.parquet(path)
    if verify and mode != "ignore":
        check_written(df, back, before + seen.get["rows"], partition_by)
    return back


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_csv(df: DataFrame, path: str, *, header: bool = True, mode: str = "overwrite") -> None:
    if mode == "overwrite":
        _refuse_self_overwrite(df, path)
    df.write.mode(mode).option("header", header).option("escape", '"').csv(path)


def write_json_lines(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    if mode == "overwrite":
        _refuse_self_overwrite(df, path)
    df.write.mode(mode).json(path)


def write_valid_countries(df: DataFrame, path: str, *, column: str = "country", header: bool = False) -> None:
    """One name per line; with ``header`` a first line ``country`` is written."""
    out = df.select(F.col(column).alias("country"))
    out.write.mode("overwrite").option("header", header).option("sep", "\t").option("quote", "\u0000").csv(path)


def write_language_map(
    df: DataFrame,
    path: str,
    *,
    shape: str = "array",
    country: str = "country",
    languages: str = "Languages",
) -> None:
    """Write the lookup as JSON.

    ``shape="array"`` writes one array of records, ``"object"`` one object
    ``{country: [languages]}`` (duplicate countries are unioned), ``"lines"``
    JSON lines.  The first two are one document by definition, so one task
    writes them; they are for lookups (one row per country).  Use ``"lines"``
    for a table that grows.
    """
    if shape == "lines":
        df.select(F.col(country).alias("country"), F.col(languages).alias("Languages")).write.mode(
            "overwrite"
        ).json(path)
        return
    if shape == "array":
        doc = F.to_json(
            F.array_sort(F.collect_list(F.struct(F.col(country).alias("country"),
                                                 F.col(languages).alias("Languages"))))
        )
        out = df.agg(doc.alias("value"))
    elif shape == "object":
        per_key = df.groupBy(country).agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list(languages)))).alias("langs")
        )
        out = per_key.agg(
            F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(country, "langs"))))).alias("value")
        )
    else:
        raise ValueError(f"unknown shape {shape!r}")
    out.coalesce(1).write.mode("overwrite").text(path)

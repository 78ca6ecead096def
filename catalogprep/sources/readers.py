"""Readers: CSV / text / JSON / Parquet with declared schemas.

Nothing here infers a schema (inference is an extra full pass over the input
and makes one stray token change a column's type).  Every reader is lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogprep import schemas


def read_titles_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.RAW_TITLES,
    *,
    header: bool = True,
    multi_line: bool = False,
    rfc4180_quotes: bool = True,
    keep_corrupt: bool = True,
) -> DataFrame:
    """Scan a titles CSV in PERMISSIVE mode with an explicit all-string schema.

    * ``multi_line=False`` (the default) keeps the file splittable across
      tasks; turn it on only when quoted fields hold newlines, since a
      multi-line CSV is read by one task per file.
    * ``rfc4180_quotes`` treats ``""`` inside a quoted field as one quote.
    * ``keep_corrupt`` adds ``_corrupt_record`` holding the raw line of every
      row with too few or too many fields (short rows are null-padded, surplus
      tokens dropped, as Spark's PERMISSIVE mode does).
    """
    if keep_corrupt and schemas.CORRUPT_RECORD not in schema.fieldNames():
        schema = T.StructType(
            list(schema.fields) + [T.StructField(schemas.CORRUPT_RECORD, T.StringType(), True)]
        )
    reader = (
        spark.read.schema(schema)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("multiLine", multi_line)
        .option("enforceSchema", True)
    )
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", schemas.CORRUPT_RECORD)
    if rfc4180_quotes:
        reader = reader.option("quote", '"').option("escape", '"')
    return reader.csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, *, header: bool = True) -> DataFrame:
    """Generic CSV scan with a declared schema (used for the EDA inputs too)."""
    return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)


def read_valid_countries(spark: SparkSession, path: str, *, header: bool = True) -> DataFrame:
    """One name per line -> ``country string``.

    ``header`` says whether line 1 is a column title (the published file has
    one, the generator writes none).  Names are trimmed; blank lines dropped.
    A tab separator is used so a name containing a comma stays whole.
    """
    df = (
        spark.read.schema(schemas.VALID_COUNTRIES)
        .option("header", header)
        .option("sep", "\t")
        .option("quote", "\u0000")
        .csv(path)
    )
    name = F.trim("country")
    return df.select(name.alias("country")).where(name != "")


def read_text_lines(spark: SparkSession, path: str, column: str = "value") -> DataFrame:
    """Plain text scan, one row per line, renamed to ``column``."""
    return spark.read.text(path).withColumnRenamed("value", column)


_RECORDS = "array<struct<country:string,Languages:array<string>>>"
_OBJECT = "map<string,array<string>>"


def _entries_from_document(doc: Column) -> Column:
    """Array of (country, Languages) structs from either JSON document shape."""
    as_records = F.from_json(doc, _RECORDS)
    as_object = F.transform(
        F.map_entries(F.from_json(doc, _OBJECT)),
        lambda e: F.struct(e["key"].alias("country"), e["value"].alias("Languages")),
    )
    return F.when(F.ltrim(doc).startswith("["), as_records).otherwise(as_object)


def read_language_map(spark: SparkSession, path: str, *, shape: str = "auto") -> DataFrame:
    """Country -> languages lookup as ``country string, Languages array<string>``.

    ``shape``:
      * ``"auto"`` — one JSON document per file, either an array of
        ``{"country", "Languages"}`` records or one object
        ``{country: [languages]}``; detected per file from its first character.
      * ``"lines"`` — JSON lines, one record per line (splittable).
    Duplicate countries are kept; :func:`catalogprep.operators.multivalue.member_lookup`
    unions them.
    """
    if shape == "lines":
        return spark.read.schema(schemas.LANGUAGE_MAP).json(path)
    if shape != "auto":
        raise ValueError(f"unknown language map shape {shape!r}")
    docs = spark.read.text(path, wholetext=True)
    return docs.select(F.explode(_entries_from_document(F.col("value"))).alias("e")).select(
        F.col("e.country").alias("country"), F.col("e.Languages").alias("Languages")
    )


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON-lines scan with a declared schema."""
    return spark.read.schema(schema).json(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Multi-line JSON (one array of records per file) with a declared schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

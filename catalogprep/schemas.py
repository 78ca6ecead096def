"""Declared schemas of the catalogue tables (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_TITLE_COLUMNS: tuple[str, ...] = (
    "show_id", "type", "title", "director", "cast", "country", "date_added",
    "release_year", "rating", "duration", "listed_in", "description",
)

#: The raw titles CSV: every field is read as text and typed later with
#: ``try_cast`` so that one bad token never changes a column's type.
RAW_TITLES = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_TITLE_COLUMNS])

CORRUPT_RECORD = "_corrupt_record"

RAW_TITLES_WITH_CORRUPT = T.StructType(
    list(RAW_TITLES.fields) + [T.StructField(CORRUPT_RECORD, T.StringType(), True)]
)

_S, _I, _D = T.StringType(), T.IntegerType(), T.DateType()
_A = T.ArrayType(T.StringType(), True)

#: The clean table, 21 columns in output order.
CLEAN_TITLES = T.StructType([
    T.StructField("show_id", _S), T.StructField("type", _S), T.StructField("title", _S),
    T.StructField("director", _S), T.StructField("cast", _S), T.StructField("date_added", _S),
    T.StructField("release_year", _I), T.StructField("rating", _S),
    T.StructField("movie_duration", _I), T.StructField("seasons", _I),
    T.StructField("description", _S), T.StructField("released_countries", _A),
    T.StructField("released_languages", _A), T.StructField("movie_type", _S),
    T.StructField("show_type", _S), T.StructField("genres", _A),
    T.StructField("added_date", _D), T.StructField("year", _S), T.StructField("month", _S),
    T.StructField("day", _S), T.StructField("day_of_week", _S),
])

CLEAN_TITLE_COLUMNS: tuple[str, ...] = tuple(f.name for f in CLEAN_TITLES.fields)

VALID_COUNTRIES = T.StructType([T.StructField("country", T.StringType(), True)])

LANGUAGE_MAP = T.StructType([
    T.StructField("country", T.StringType(), True),
    T.StructField("Languages", T.ArrayType(T.StringType(), True), True),
])

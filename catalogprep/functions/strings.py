"""Scalar string helpers — all built-in Column expressions (JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogprep.functions._util import col_of

#: Separator of multi-valued attributes: a comma plus any whitespace.
LIST_SEPARATOR = r",\s*"


def strip_leading_comma(c: str | Column) -> Column:
    """Remove a stray leading comma (``", France"`` -> ``"France"``)."""
    return F.regexp_replace(col_of(c), r"^\s*,\s*", "")


def split_list(c: str | Column, pattern: str = LIST_SEPARATOR) -> Column:
    """Comma list -> ``array<string>``.  Keeps a trailing ``''`` and maps
    ``''`` to ``['']``, exactly like ``split`` with limit -1."""
    return F.split(col_of(c), pattern)


def split_literal(c: str | Column, sep: str = ", ") -> Column:
    """Split on a literal separator (regex metacharacters escaped)."""
    import re

    return F.split(col_of(c), re.escape(sep))


def split_trim(c: str | Column, sep: str = ",") -> Column:
    """Split on a literal separator and trim every element."""
    import re

    return F.transform(F.split(col_of(c), re.escape(sep)), lambda x: F.trim(x))


def remove_unit(c: str | Column, unit: str = " min") -> Column:
    """Drop a unit suffix text such as ``' min'``."""
    import re

    return F.regexp_replace(col_of(c), re.escape(unit), "")


def digits_only(c: str | Column) -> Column:
    """Keep the digits of a string (``'2 Seasons'`` -> ``'2'``)."""
    return F.regexp_replace(col_of(c), r"\D", "")


def to_int(c: str | Column) -> Column:
    """Text -> int, NULL for anything not an integer (``' 2020 '`` -> 2020)."""
    return col_of(c).try_cast("int")


def first_number(c: str | Column) -> Column:
    """First run of digits as a double, NULL when there is none."""
    return F.nullif(F.regexp_extract(col_of(c), r"(\d+)", 1), F.lit("")).try_cast("double")


def contains_text(c: str | Column, needle: str) -> Column:
    return col_of(c).contains(needle)

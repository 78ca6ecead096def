"""Date parsing and calendar parts (built-in expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogprep.functions._util import col_of

#: Text layout of ``date_added`` (``July 24, 2020``).
ADDED_DATE_FORMAT = "MMMM d, yyyy"

MONTHS = ("January", "February", "March", "April", "May", "June", "July",
          "August", "September", "October", "November", "December")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def parse_text_date(c: str | Column, fmt: str = ADDED_DATE_FORMAT, *, trim: bool = True) -> Column:
    """Text -> date; NULL (never an error) for ``'Unknown'``, ``'July 24'``,
    ``'Jan 1, 2023'`` or impossible days.  Leading/trailing blanks are
    trimmed first unless ``trim=False``."""
    src = col_of(c)
    return F.try_to_date(F.trim(src) if trim else src, fmt)


def date_text_parts(c: str | Column) -> dict[str, Column]:
    """year / month name / day / weekday name as **text** (``'2020'``,
    ``'July'``, ``'24'``, ``'Friday'``)."""
    d = col_of(c)
    return {
        "year": F.date_format(d, "yyyy"),
        "month": F.date_format(d, "MMMM"),
        "day": F.date_format(d, "d"),
        "day_of_week": F.date_format(d, "EEEE"),
    }


def date_int_parts(c: str | Column, prefix: str = "added_") -> dict[str, Column]:
    """year / month / day as ints and day of week with Monday = 0."""
    d = col_of(c)
    return {
        f"{prefix}year": F.year(d),
        f"{prefix}month": F.month(d),
        f"{prefix}day": F.dayofmonth(d),
        f"{prefix}dayofweek": F.weekday(d),
    }


def age_in_years(year_col: str | Column, as_of: int | None = None) -> Column:
    """Years since ``year_col``.  ``as_of`` pins the reference year so the
    result does not change with the calendar; default: the current year."""
    ref = F.lit(as_of) if as_of is not None else F.year(F.current_date())
    return ref - col_of(year_col)

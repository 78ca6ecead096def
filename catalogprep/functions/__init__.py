"""Scalar Column helpers."""

from catalogprep.functions.dates import (
    ADDED_DATE_FORMAT, MONTHS, WEEKDAYS, age_in_years, date_int_parts, date_text_parts,
    parse_text_date,
)
from catalogprep.functions.strings import (
    LIST_SEPARATOR, contains_text, digits_only, first_number, remove_unit, split_list,
    split_literal, split_trim, strip_leading_comma, to_int,
)

__all__ = [
    "ADDED_DATE_FORMAT", "MONTHS", "WEEKDAYS", "age_in_years", "date_int_parts",
    "date_text_parts", "parse_text_date", "LIST_SEPARATOR", "contains_text", "digits_only",
    "first_number", "remove_unit", "split_list", "split_literal", "split_trim",
    "strip_leading_comma", "to_int",
]

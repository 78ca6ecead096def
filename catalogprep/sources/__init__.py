"""Sources and sinks."""

from catalogprep.sources.lookups import language_map_df, valid_countries_df
from catalogprep.sources.readers import (
    read_csv,
    read_json_array,
    read_json_lines,
    read_language_map,
    read_parquet,
    read_table,
    read_text_lines,
    read_titles_csv,
    read_valid_countries,
)
from catalogprep.sources.writers import (
    write_csv,
    write_json_lines,
    write_language_map,
    write_parquet,
    write_valid_countries,
)

__all__ = [
    "language_map_df", "valid_countries_df", "read_csv", "read_json_array", "read_json_lines",
    "read_language_map", "read_parquet", "read_table", "read_text_lines", "read_titles_csv",
    "read_valid_countries", "write_csv", "write_json_lines", "write_language_map",
    "write_parquet", "write_valid_countries",
]

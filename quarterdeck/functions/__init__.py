"""Column and column-name helpers; everything stays inside Spark expressions."""

from quarterdeck.functions.columns import (
    clean_names,
    columns_of,
    display_integer,
    display_number,
    interleaved,
    last_segment,
    quoted,
    rename_columns,
    series_title,
    trim_text,
    typed,
)

__all__ = [
    "clean_names",
    "columns_of",
    "display_integer",
    "display_number",
    "interleaved",
    "last_segment",
    "quoted",
    "rename_columns",
    "series_title",
    "trim_text",
    "typed",
]

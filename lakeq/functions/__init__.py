"""Column-level building blocks: names, text cleaning, lenient casts, percentages."""

from lakeq.functions.casts import (
    lenient_cast,
    lenient_int,
    numeric_text_ok,
    parse_date,
)
from lakeq.functions.names import standardize_columns, standardize_name
from lakeq.functions.text import (
    NA_TOKENS,
    blank_to_null,
    clean_file_name,
    na_to_null,
    whitespace_to_null,
)

__all__ = [
    "NA_TOKENS",
    "blank_to_null",
    "clean_file_name",
    "lenient_cast",
    "lenient_int",
    "na_to_null",
    "numeric_text_ok",
    "parse_date",
    "standardize_columns",
    "standardize_name",
    "whitespace_to_null",
]

"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Missing-value tokens of the profiling reader. The first ten are
# the tokens passed explicitly; the rest are pandas' default NA strings, which
# the reader keeps enabled.
NA_TOKENS = (
    "", " ", "NA", "N/A", "NULL", "null", "-", ".", "Unknown", "unknown",
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "NaN", "None", "n/a", "nan",
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """Trim spaces; a value that is empty after trimming becomes NULL.

    Spark's trim removes spaces only, so '\\t ' survives (trap T5)."""
    return F.nullif(F.trim(_c(c).cast("string")), F.lit(""))


def na_to_null(c, tokens=NA_TOKENS) -> Column:
    """A value equal to one of the NA tokens becomes NULL."""
    col = _c(c)
    return F.when(col.isin(list(tokens)), F.lit(None).cast("string")).otherwise(col)


# The characters of the regex class \s: space, tab, newline, vertical tab, form feed, return.
_WHITESPACE = " \t\n\u000b\f\r"


def _blank_any(col: Column) -> Column:
    """True when the value is empty or made only of those characters (no regex)."""
    return F.btrim(col, F.lit(_WHITESPACE)) == ""


def whitespace_to_null(c) -> Column:
    """A value made only of white space (any mix of the characters above) becomes NULL."""
    col = _c(c)
    return F.when(_blank_any(col), F.lit(None).cast("string")).otherwise(col)


def profile_text(c) -> Column:
    """Text as the profiling reader sees it: NA tokens and white-space-only
    values become NULL (one test per value)."""
    col = _c(c)
    return F.when(col.isin(list(NA_TOKENS)) | _blank_any(col), F.lit(None).cast("string")).otherwise(col)


def clean_file_name(c) -> Column:
    """Landed file name. NULL/empty -> 'unknown.csv'; otherwise strip white
    space, turn ' ', '/', '\\' into '_'; always end in '.csv'."""
    col = _c(c)
    stripped = F.regexp_replace(col, r"(?U)^\s+|\s+$", "")
    replaced = F.regexp_replace(stripped, r"[ /\\]", "_")
    named = F.when(col.isNull() | (col == ""), F.lit("unknown.csv")).otherwise(replaced)
    return F.when(named.endswith(".csv"), named).otherwise(F.concat(named, F.lit(".csv")))

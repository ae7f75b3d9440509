"""Lenient casts that keep legacy (non-ANSI) results under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGRAL = {"tinyint", "smallint", "int", "integer", "bigint", "long", "short", "byte"}
# Plain decimal / scientific numbers only; rejects '1d', '1f', 'NaN', 'Infinity'.
NUMERIC_TEXT_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# One pass over the text: surrounding characters <= ' ' (trimmed by the legacy
# cast), sign, digits, optional fraction. At least one digit or dot is needed.
# The replacement keeps sign + '0' + integer digits, so '.5' -> '0', '-1.9' ->
# '-01'; text that does not match is left as is and fails the cast.
_INT_SHAPE = r"^[\x00-\x20]*(?<s>[+-]?)(?=[0-9.])(?<d>[0-9]*)(?:\.[0-9]*)?[\x00-\x20]*$"


def lenient_int(c, type_name: str = "int") -> Column:
    """Integral cast with legacy truncation: '12.7' -> 12, '-1.9' -> -1, '.5' -> 0,
    '.' -> 0; '1e2', '1,000', '+', overflow -> NULL (trap T2).

    A failing cast costs ten times a pattern, so text with a dot takes the regex at
    once; all other text takes the direct cast, which trims as the legacy one does."""
    text = _c(c).cast("string")
    dotted = F.regexp_replace(text, _INT_SHAPE, "${s}0${d}").try_cast(type_name)
    return F.when(F.instr(text, ".") > 0, dotted).otherwise(text.try_cast(type_name))


def numeric_text_ok(c) -> Column:
    """True when trimmed text is a plain number (trap T10); NULL stays NULL."""
    return F.trim(_c(c).cast("string")).rlike(NUMERIC_TEXT_PATTERN)


def lenient_double(c) -> Column:
    """Plain-number text to double in one regex pass; anything else -> NULL."""
    whole = "(" + NUMERIC_TEXT_PATTERN[1:-1] + ")"
    return F.regexp_extract(F.trim(_c(c).cast("string")), "^" + whole + "$", 1).try_cast("double")


def parse_date(c, fmt: str = "yyyyMMdd") -> Column:
    """Text to date with an explicit pattern; bad text -> NULL (trap T4)."""
    return F.try_to_date(_c(c).cast("string"), fmt)


def lenient_cast(c, type_name: str) -> Column:
    """Cast one column to a contract type without raising on bad values."""
    t = type_name.strip().lower()
    col = _c(c)
    if t == "string":
        return col.cast("string")
    if t in _INTEGRAL:
        return lenient_int(col, t)
    if t in ("double", "float"):
        return lenient_double(col).cast(t)
    if t == "date":
        return parse_date(col, "yyyy-MM-dd")
    # decimal(p,s), boolean, timestamp: try_cast gives NULL on bad text or overflow.
    return F.trim(col.cast("string")).try_cast(t)

"""Header standardisation (P1, P2) with collision detection (trap T6).

Renaming is metadata only: one ``select`` of aliased columns.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeq.contracts import ContractError


def quoted(name: str) -> str:
    """A column name as SQL and ``F.col`` take it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def standardize_name(name: str) -> str:
    """The runs of a-z and 0-9 in the lower-cased name, joined by '_'."""
    return "_".join(re.findall("[a-z0-9]+", name.lower()))


def standardized_names(columns: list[str]) -> list[str]:
    """Standard names for a header; raises ContractError when two map to one name."""
    seen: dict[str, str] = {}
    out = []
    for original in columns:
        std = standardize_name(original)
        if std in seen:
            raise ContractError(
                f"columns {seen[std]!r} and {original!r} both standardise to {std!r}")
        seen[std] = original
        out.append(std)
    return out


def standardize_columns(df: DataFrame) -> DataFrame:
    names = standardized_names(df.columns)
    return df.select([F.col(quoted(c)).alias(n) for c, n in zip(df.columns, names)])

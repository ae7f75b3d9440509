"""P22 as a mergeable state: what the values of a column look like, counted.

Each value falls into one class of a lattice (integer < long integer, number < text;
boolean < text; missing below all) by the shape of its characters; a cast is tried only
for integers of 19 digits or more, where the shape can't tell whether bigint holds
them. The state of a column is how many values fell into each class, so the states of
parts (runs, files, partitions) add up to that of the whole, and the type is decided
from the sum without reading any part again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeq.functions.casts import NUMERIC_TEXT_PATTERN
from lakeq.functions.names import quoted

CLASSES = ("ints", "longs", "nums", "bools")
_SHORT_INT = r"^[+-]?[0-9]{1,18}$"
_INT = r"^[+-]?[0-9]+$"
# Characters that a cast trims but trim() leaves.
_PADDED = r"^[\x00-\x1F]|[\x00-\x1F]$"
_BOOL_TOKENS = ("True", "False", "TRUE", "FALSE", "true", "false")


def _text(v) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def value_class(column: str) -> str:
    """SQL text: the class of a text value (NULL of a missing one)."""
    t = f"trim(CAST({quoted(column)} AS STRING))"
    bools = ", ".join(_text(b) for b in _BOOL_TOKENS)
    return (f"CASE WHEN {quoted(column)} IS NULL THEN NULL WHEN {t} RLIKE {_text(_SHORT_INT)} THEN 'ints' "
            f"WHEN {t} RLIKE {_text(_INT)} THEN IF(try_cast({t} AS BIGINT) IS NULL, 'longs', 'ints') "
            f"WHEN {t} RLIKE {_text(NUMERIC_TEXT_PATTERN)} THEN 'nums' WHEN {t} IN ({bools}) THEN 'bools' "
            f"WHEN {t} RLIKE {_text(_PADDED)} AND try_cast({t} AS BIGINT) IS NOT NULL THEN 'ints' ELSE 'text' END")


def type_state(df: DataFrame) -> DataFrame:
    """(position, column_name, dtype, n, present, ints, longs, nums, bools): one row a
    column, from one aggregate. Counts of classes are NULL of columns that are not text."""
    fields = df.schema.fields
    text = {f.name for f in fields if isinstance(f.dataType, T.StringType)}
    classes = df.selectExpr(*[f"{value_class(f.name) if f.name in text else quoted(f.name) + ' IS NOT NULL'} AS k{i}"
                              for i, f in enumerate(fields)])
    counted = [F.count(F.lit(1)).alias("n")]
    states = []
    for i, f in enumerate(fields):
        if f.name in text:
            counted += [F.count(f"k{i}").alias(f"p{i}")] + [F.count_if(F.col(f"k{i}") == c).alias(f"{c}{i}") for c in CLASSES]
            of_class = [f"{c}{i}" for c in CLASSES]
        else:
            counted.append(F.count_if(f"k{i}").alias(f"p{i}"))
            of_class = ["CAST(NULL AS BIGINT)"] * len(CLASSES)
        states.append(f"named_struct('position', {i}, 'column_name', {_text(f.name)}, 'dtype', {_text(f.dataType.simpleString())}, "
                      f"'n', n, 'present', p{i}, " + ", ".join(f"'{c}', {x}" for c, x in zip(CLASSES, of_class)) + ")")
    return classes.agg(*counted).selectExpr(f"inline(array({', '.join(states)}))")


def merge_type_states(*states: DataFrame) -> DataFrame:
    """The state of the union. A column that is text in one part and not in another
    counts as text whose other values are unknown, so it stays text."""
    every = reduce(DataFrame.unionByName, states)
    typed = F.count_if(F.col("dtype") != "string") > 0
    mixed = F.count_distinct("dtype") > 1
    return every.groupBy("column_name").agg(
        F.min("position").alias("position"), F.when(mixed, F.lit("string")).otherwise(F.first("dtype")).alias("dtype"),
        F.sum("n").alias("n"), F.sum("present").alias("present"),
        *[F.when(mixed & typed, F.lit(0)).otherwise(F.sum(c)).cast("bigint").alias(c) for c in CLASSES]).select(
        "position", "column_name", "dtype", "n", "present", *CLASSES)


def types_of(state: DataFrame) -> DataFrame:
    """The type of each column: 'bigint' when every value is an integer and none is
    missing (integers with gaps become 'double'), 'double' when every present value is a
    number (or none is present), 'boolean' for complete True/False columns, else
    'string'. Integers that bigint cannot hold stay text, so that no digit is lost."""
    return state.selectExpr(
        "column_name", "CAST(present AS BIGINT) AS non_null_count", "CAST(ints AS BIGINT) AS integer_count",
        "CAST(ints + longs + nums AS BIGINT) AS numeric_count",
        """CASE WHEN ints IS NULL THEN dtype
                WHEN present = 0 THEN 'double'
                WHEN longs > 0 THEN 'string'
                WHEN ints = present AND present = n THEN 'bigint'
                WHEN ints + nums = present THEN 'double'
                WHEN bools = present AND present = n THEN 'boolean'
                ELSE 'string' END AS inferred_type""")

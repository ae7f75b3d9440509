"""C1 refine: standard names -> blanks to NULL -> cast by contract -> lineage.

Everything is one ``select`` over the raw columns (no withColumn loops), so the
plan stays scan -> project -> write with no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeq.contracts import Lineage, TableContract
from lakeq.functions.casts import lenient_cast
from lakeq.functions.names import quoted, standardized_names
from lakeq.functions.text import blank_to_null

LINEAGE_COLUMNS = ("run_id", "dataset_name", "source_file_name", "ingest_ts_utc")


@dataclass
class Refined:
    df: DataFrame
    warnings: list[str]


def contract_warnings(columns: list[str], contract: TableContract) -> list[str]:
    """P5: contract columns absent from the data are reported, not fatal."""
    have = set(columns)
    return [f"{contract.name}: no column {c!r} in the data, so it is not cast"
            for c in contract.columns if c not in have]


def lineage_columns(lineage: Lineage) -> list:
    """P6 (+P14): lineage literals; the stamp is the run's fixed time."""
    return [
        F.lit(lineage.run_id).alias("run_id"),
        F.lit(lineage.dataset_name).alias("dataset_name"),
        F.lit(lineage.source_file_name).alias("source_file_name"),
        F.lit(lineage.run_ts).cast("timestamp").alias("ingest_ts_utc"),
    ]


def cleaned(raw: DataFrame) -> DataFrame:
    """P1 + P3: standard names (collisions raise, trap T6) and blanks to NULL, as
    one projection. Later casts read these columns instead of re-deriving them."""
    names = standardized_names(raw.columns)
    return raw.select([blank_to_null(F.col(quoted(o))).alias(n) for o, n in zip(raw.columns, names)])


def refine(raw: DataFrame, contract: TableContract, lineage: Lineage | None = None) -> Refined:
    """Standardise headers, trim blanks to NULL, cast contract columns, add lineage."""
    clean = cleaned(raw)
    warnings = contract_warnings(clean.columns, contract)
    cols = [lenient_cast(F.col(c), contract.columns[c]).alias(c) if c in contract.columns else F.col(c)
            for c in clean.columns]
    if lineage is not None:
        cols.extend(lineage_columns(lineage))
    return Refined(clean.select(cols), warnings)


def cast_loss(raw: DataFrame, contract: TableContract) -> DataFrame:
    """Per contract column, rows whose cleaned text was non-NULL but whose
    cast is NULL. One aggregate over the raw scan; result is one row per column."""
    clean = cleaned(raw)
    present = [c for c in clean.columns if c in contract.columns]
    if not present:
        return raw.sparkSession.createDataFrame([], "column_name string, cast_loss bigint")
    wide = clean.agg(*[
        F.count_if(F.col(c).isNotNull() & lenient_cast(F.col(c), contract.columns[c]).isNull()).alias(c)
        for c in present])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("bigint").alias("cast_loss"))
        for c in present
    ])))


def contract_report(raw: DataFrame, contract: TableContract) -> DataFrame:
    """P5 as rows: each contract column with its type, whether the data has it, the rows
    with text before and a value after the cast, and the warning where it is absent
    (both counts are then NULL). One aggregate over the raw scan."""
    clean = cleaned(raw)
    warnings = dict(zip([c for c in contract.columns if c not in clean.columns],
                        contract_warnings(clean.columns, contract)))
    counts = [F.count(F.lit(1)).alias("__lq_rows")]
    for i, (c, t) in enumerate(contract.columns.items()):
        if c not in warnings:
            counts += [F.count(c).alias(f"__lq_text{i}"), F.count(lenient_cast(F.col(c), t)).alias(f"__lq_value{i}")]
    none = F.lit(None).cast("bigint")
    return clean.agg(*counts).select("__lq_rows", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("type"), F.lit(c not in warnings).alias("in_data"),
                 (none if c in warnings else F.col(f"__lq_text{i}")).alias("with_text"),
                 (none if c in warnings else F.col(f"__lq_value{i}")).alias("with_value"),
                 F.lit(warnings.get(c)).cast("string").alias("warning"))
        for i, (c, t) in enumerate(contract.columns.items())]))).withColumnRenamed("__lq_rows", "row_count")

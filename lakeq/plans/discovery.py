"""C5 / C6 at the file level: profile a landed CSV the way the discovery
notebooks did — encoding fallback, NA tokens and white space to NULL, types
inferred from the data — then the distributed profile and checks."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakeq.functions.casts import parse_date
from lakeq.operators import checks, profile
from lakeq.sources.csv import read_csv_with_fallback


def read_for_profiling(spark: SparkSession, path: str):
    """S2 + P15/P16 + P22: the typed frame, the encoding used and the inferred
    types (one small row per column is collected)."""
    raw, encoding = read_csv_with_fallback(spark, path)
    text = profile.profile_read(raw)
    types = {r.column_name: r.inferred_type for r in profile.infer_types(text).collect()}
    return profile.apply_inferred_types(text, types), encoding, types


def profile_file(spark: SparkSession, path: str, name: str | None = None, key: list[str] | None = None,
                 date_column: str | None = None, date_format: str = "yyyyMMdd",
                 work_dir: str | None = None) -> dict:
    """Everything the file profiler reports, as DataFrames, plus the optional
    key check (A14, null-safe) and calendar-gap check (U2). With ``work_dir`` (a
    shared directory) the typed table is written there once, and the outputs read
    its columns instead of parsing the CSV file again for each."""
    df, encoding, types = read_for_profiling(spark, path)
    if work_dir:
        df.write.mode("overwrite").parquet(f"{work_dir.rstrip('/')}/typed")
        df = spark.read.schema(df.schema).parquet(f"{work_dir.rstrip('/')}/typed")
    out = profile.profile(df, name or path.rsplit("/", 1)[-1])
    out["encoding"], out["types"] = encoding, types
    if key:
        out["duplicate_keys"] = checks.duplicate_key_rows(df, key, null_safe=True)
    if date_column:
        text = F.col(date_column)
        if types.get(date_column) != "string":  # numbers, perhaps read as double for their gaps
            text = text.try_cast("bigint").cast("string")
        day = parse_date(text, date_format)
        out["missing_dates"] = checks.missing_dates(df.select(day.alias("d")), "d")
    return out


def key_report_files(spark: SparkSession, paths: dict[str, str], keys: dict[str, tuple] | None = None):
    """A19 over landed files: each dataset read as text, headers standardised,
    then rows / distinct keys / duplicated rows of its declared key (one row
    per dataset). ``keys`` defaults to the staffing model's declared keys."""
    from lakeq.functions.names import standardize_columns
    from lakeq.models.staffing import DATASET_KEYS
    from lakeq.sources.csv import read_csv_strings

    keys = keys or DATASET_KEYS
    frames = {name: (standardize_columns(read_csv_strings(spark, path)), list(keys[name]))
              for name, path in paths.items()}
    return checks.key_reports(frames)

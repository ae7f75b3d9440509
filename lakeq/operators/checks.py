"""C6 checks: duplicate keys (null-safe), calendar gaps, range violations, key report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeq.functions.casts import lenient_double, parse_date
from lakeq.operators.joins import DEFAULT_TARGET_ROWS, key_counts, split_join


def duplicate_key_rows(df: DataFrame, keys, null_safe: bool = True,
                       target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Every row whose key repeats, all copies kept, with the copy count.

    ``null_safe=True`` treats NULL key parts as equal (the profiler's rule);
    ``False`` uses SQL semantics (NULL keys never repeat, trap T7). Key counts
    combine map-side; rows of keys above ``target_rows`` rows, a huge NULL group
    included, stay out of the shuffle of the join back."""
    keys = list(keys)
    src = df if null_safe else df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    counts = key_counts(src, keys)
    dups = counts.where(F.col("__lq_n") > 1).withColumnRenamed("__lq_n", "dup_count")
    return split_join(src, dups, keys, "inner", counts=counts, target_rows=target_rows)


def key_report(df: DataFrame, keys, table: str) -> DataFrame:
    """Rows, distinct keys and duplicated rows for one declared key. An
    empty key declares a single-row table: every row beyond the first is a
    duplicate."""
    keys = list(keys)
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__k"))
    return groups.agg(
        F.coalesce(F.sum("__k"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count_if(F.col("__k") > 0).cast("bigint").alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col("__k") > 1, F.col("__k"))), F.lit(0)).cast("bigint")
        .alias("duplicate_key_rows"),
    ).select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
             "row_count", "distinct_keys", "duplicate_key_rows",
             (F.col("duplicate_key_rows") == 0).alias("key_unique"))


def key_reports(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """A19 over a (table -> (frame, key)) contract: one row per table."""
    frames = [key_report(df, keys, name) for name, (df, keys) in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


def _day(df: DataFrame, date_col, fmt: str) -> Column:
    """A day from a date, timestamp or text column (bad text: NULL) or an expression."""
    if not isinstance(date_col, str):
        return date_col
    if dict(df.dtypes)[date_col] == "string":
        return parse_date(F.col(date_col), fmt)
    return F.to_date(F.col(date_col))


def date_bounds(df: DataFrame, date_col, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """First and last day."""
    d = _day(df, date_col, fmt)
    return df.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"))


def file_bounds(spark: SparkSession, path: str, columns) -> DataFrame:
    """A13 / A18 from file statistics: row_count, and min_ and max_ of whole-number and date
    columns, of a Parquet folder whose writer kept them (Spark does). Only the footers
    are read. The setting for it lives in a session of its own."""
    own = spark.newSession()
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    df = own.read.parquet(path)
    fit = ("tinyint", "smallint", "int", "bigint", "date")
    unfit = [c for c in columns if dict(df.dtypes)[c] not in fit]
    if unfit:
        raise ValueError(f"files hold no exact bounds of {unfit}; take date_bounds or numeric_summary")
    return df.agg(F.count(F.lit(1)).alias("row_count"), *[
        f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def date_gaps(df: DataFrame, date_col, by: list[str] | None = None, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """U2 as islands and gaps: (by..., gap_from, gap_to, gap_days), the runs of days
    without a row between a group's first and last day.

    Days are reduced to distinct (group, day) before the shuffle, so a hot group is no
    longer than its calendar; each day is compared with the next one of its group."""
    by = list(by or [])
    d = _day(df, date_col, fmt)
    observed = df.select(*by, d.alias("day")).where(F.col("day").isNotNull()).distinct()
    if by:
        after = observed.withColumn("after", F.lead("day").over(Window.partitionBy(*by).orderBy("day")))
    else:  # one calendar: its months share the work, each with the first day of the next month that has one
        month = observed.withColumn("month", F.trunc("day", "month"))
        first = month.groupBy("month").agg(F.min("day").alias("first"))
        following = first.select("month", F.lead("first").over(Window.orderBy("month")).alias("following"))
        after = (month.withColumn("after", F.lead("day").over(Window.partitionBy("month").orderBy("day")))
                 .join(F.broadcast(following), "month").withColumn("after", F.coalesce("after", "following")))
    days = F.datediff("after", "day") - 1
    return after.where(days > 0).select(*by, F.date_add("day", 1).alias("gap_from"),
                                        F.date_sub("after", 1).alias("gap_to"), days.alias("gap_days"))


def missing_dates(df: DataFrame, date_col, by: list[str] | None = None, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Calendar days between the first and last observed day with no row.

    Only the gaps are exploded, so the size goes with the result, not with groups times
    calendar. ``by`` gives a per-group calendar (each group's own first..last day)."""
    gaps = date_gaps(df, date_col, by, fmt)
    return gaps.select(*(by or []), F.explode(F.sequence("gap_from", "gap_to", F.expr("interval 1 day"))).alias("missing_date"))


def range_violations(df: DataFrame, column: str, min_value=0, max_value=None) -> DataFrame:
    """rows whose value (numbers parsed leniently from text) is below
    ``min_value`` or above ``max_value``; unparseable values and NaN never violate."""
    kind = dict(df.dtypes)[column]
    v = lenient_double(F.col(column)) if kind == "string" else F.col(column).cast("double")
    bad = v < F.lit(min_value)
    if max_value is not None:
        over = v > F.lit(max_value)
        # NaN sorts above all numbers, infinity included; comparisons reach the scan
        bad = bad | (over & (v <= F.lit(float("inf"))) if kind in ("float", "double") else over)
    return df.where(bad)

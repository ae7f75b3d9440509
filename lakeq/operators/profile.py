"""C5 profile: overview, column catalog, column profile, numeric summary, IQR outliers.

Distributed replacements for a single-process data-frame profiler:
- the column profile is one wide aggregate, unpivoted to one row per column;
- quartiles are exact without holding a column in one task: values are
  counted per (column, value), range-partitioned, and ranks are found from
  per-partition running counts (see ``exact_quantiles``);
- outliers are counted on the same per-value counts, joined with the fences of
  their column (one row per column).

NaN counts as missing throughout, as data-frame readers treat it. Results are not
rounded unless the caller asks for it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeq.functions.casts import NUMERIC_TEXT_PATTERN as _NUMERIC_RX
from lakeq.functions.names import quoted as _q
from lakeq.functions.text import profile_text
from lakeq.operators.type_lattice import type_state, types_of
from lakeq.session import ensure_checkpoint_dir

# Fixed value: the type-issue text of the profile.
NUMERIC_LIKE_ISSUE = "Possible numeric values stored as text"
_NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                  T.DecimalType)


def without_nan(df: DataFrame) -> DataFrame:
    """NaN of float and double columns as NULL."""
    floats = (T.FloatType, T.DoubleType)
    if not any(isinstance(f.dataType, floats) for f in df.schema.fields):
        return df
    return df.select([F.when(~F.isnan(F.col(_q(f.name))), F.col(_q(f.name))).alias(f.name)
                      if isinstance(f.dataType, floats) else F.col(_q(f.name)) for f in df.schema.fields])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC_TYPES)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def column_catalog(df: DataFrame, table: str | None = None) -> DataFrame:
    """(column_name, dtype) from the schema — metadata only, no job."""
    rows = [(table, f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "table_name string, column_name string, dtype string")


def dataset_overview(df: DataFrame, table: str) -> DataFrame:
    """Rows and columns of one table."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"))


def _pct(num, total):
    """round(100 * num / total, 2), and 0 for an empty table."""
    return F.when(total == 0, F.lit(0.0)).otherwise(F.round(num * 100.0 / total, 2))


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _stack(wide: DataFrame, rows: list[list[str]], names: list[str]) -> DataFrame:
    """Unpivot a one-row aggregate: ``rows`` holds one list of SQL expressions
    per output row (same arity as ``names``). One SQL expression instead of a
    struct per column keeps plan construction cheap for wide tables."""
    body = ", ".join(e for row in rows for e in row)
    return wide.selectExpr(f"stack({len(rows)}, {body}) AS ({', '.join(names)})")


def _distinct_counts(df: DataFrame, approx: bool, chunk: int) -> DataFrame:
    """(column_name, distinct) for every column.

    Several exact distinct counts in one aggregate plan an Expand (one row copy
    per counted column). Counting ``chunk`` columns per aggregate (default 4) bounds
    that blow-up; over a columnar table each chunk's scan reads only its own
    columns (a CSV file is parsed again for each: write it as a table first).
    ``chunk=1`` gives plain two-phase single-distinct aggregations; ``approx``
    uses HyperLogLog++ instead."""
    names = df.columns
    frames = []
    fn = "approx_count_distinct({})" if approx else "count(DISTINCT {})"
    for start in range(0, len(names), chunk):
        part = names[start:start + chunk]
        wide = df.agg(*[F.expr(fn.format(_q(c))).alias(f"d{start + i}") for i, c in enumerate(part)])
        frames.append(_stack(wide, [[_lit(c), f"CAST(d{start + i} AS BIGINT)"] for i, c in enumerate(part)],
                             ["column_name", "distinct"]))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def column_profile(df: DataFrame, table: str | None = None, missing_threshold: float = 0.2,
                   numeric_like_threshold: float = 0.8, approx_distinct: bool = False,
                   distinct_chunk: int = 4) -> DataFrame:
    """A6-A10 + G5: one row per column.

    Counts and the numeric-text test are one aggregate, unpivoted with one
    ``stack``; the per-column rules are then one row-wise projection. Distinct
    counts come from ``_distinct_counts`` and join back by column name (both
    sides hold one row per column)."""
    df = without_nan(df)
    strings = set(string_columns(df))
    aggs = ["count(1) AS n"]
    for i, c in enumerate(df.columns):
        aggs.append(f"count({_q(c)}) AS nn{i}")
        if c in strings:
            aggs.append(f"count_if(trim(CAST({_q(c)} AS STRING)) RLIKE {_lit(_NUMERIC_RX)}) AS num{i}")
    wide = df.agg(*[F.expr(a.rsplit(" AS ", 1)[0]).alias(a.rsplit(" AS ", 1)[1]) for a in aggs])
    long = _stack(wide, [[_lit(f.name), _lit(f.dataType.simpleString()), "n", f"nn{i}",
                          f"num{i}" if f.name in strings else "CAST(NULL AS BIGINT)",
                          "true" if f.name in strings else "false"]
                         for i, f in enumerate(df.schema.fields)],
                  ["column_name", "dtype", "n", "nn", "num", "is_text"])
    t = _lit(table) if table is not None else "CAST(NULL AS STRING)"
    prof = long.selectExpr(
        f"{t} AS table_name", "column_name", "dtype",
        "CAST(n AS BIGINT) AS row_count", "CAST(nn AS BIGINT) AS non_null_count",
        "CAST(n - nn AS BIGINT) AS missing_count",
        "CASE WHEN n = 0 THEN 0.0D ELSE round(CAST(n - nn AS DOUBLE) * 100.0D / n, 2) END AS missing_pct",
        "CASE WHEN n = 0 THEN 0.0D ELSE round(CAST(nn AS DOUBLE) * 100.0D / n, 2) END AS completeness_pct",
        f"CASE WHEN n = 0 THEN false ELSE CAST(n - nn AS DOUBLE) / n >= {float(missing_threshold)}D END"
        " AS high_missing_flag",
        f"CASE WHEN is_text AND nn > 0 AND CAST(num AS DOUBLE) / nn >= {float(numeric_like_threshold)}D"
        f" THEN {_lit(NUMERIC_LIKE_ISSUE)} ELSE '' END AS possible_type_issue")
    distinct = _distinct_counts(df, approx_distinct, max(1, distinct_chunk))
    return prof.join(distinct.withColumnRenamed("distinct", "unique_non_null_values"), "column_name").selectExpr(
        "table_name", "column_name", "dtype", "row_count", "non_null_count", "missing_count", "missing_pct",
        "completeness_pct", "unique_non_null_values", "unique_non_null_values <= 1 AS constant_column_flag",
        "high_missing_flag", "possible_type_issue")


def profile_read(df: DataFrame) -> DataFrame:
    """The profiling reader's view of landed text: NA tokens (P15) and white
    space only values (P16) become NULL in every string column."""
    strings = set(string_columns(df))
    return df.select([profile_text(F.col(_q(c))).alias(c) if c in strings else F.col(_q(c))
                      for c in df.columns])


def infer_types(df: DataFrame) -> DataFrame:
    """The type a data-frame reader would give each text column, decided from all
    its values in one aggregate (see ``type_lattice``). Other columns keep their type."""
    return types_of(type_state(without_nan(df)))


def apply_inferred_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast text columns to the inferred types (a small dict collected from ``infer_types``)."""
    from lakeq.functions.casts import lenient_cast
    return df.select([lenient_cast(F.col(_q(c)), types[c]).alias(c) if types.get(c, "string") != "string"
                      else F.col(_q(c)) for c in df.columns])


def missing_counts(df: DataFrame, table: str | None = None) -> DataFrame:
    """Missing values per column from a single aggregate of non-NULL counts."""
    df = without_nan(df)
    wide = df.agg(F.count(F.lit(1)).alias("n"),
                  *[F.expr(f"count({_q(c)})").alias(f"nn{i}") for i, c in enumerate(df.columns)])
    t = _lit(table) if table is not None else "CAST(NULL AS STRING)"
    return _stack(wide, [[t, _lit(c), f"CAST(n - nn{i} AS BIGINT)"] for i, c in enumerate(df.columns)],
                  ["table_name", "column_name", "missing_count"])


def missing_ranking(profile: DataFrame) -> DataFrame:
    """O1: columns by missing count, most missing first (input: a column
    profile or ``missing_counts``)."""
    return profile.select("table_name", "column_name", "missing_count").orderBy(
        F.desc("missing_count"), "column_name")


def duplicate_rows(df: DataFrame, table: str | None = None) -> DataFrame:
    """A5: copies beyond the first of whole rows (NULLs equal), and their share.

    Grouping combines map-side, so heavy repeats stay cheap. Text columns are
    grouped by length and SHA-256, so no long text is a shuffle key."""
    keys = []
    for f in df.schema.fields:
        c = F.col(_q(f.name))
        keys += [F.length(c), F.sha2(c, 256)] if isinstance(f.dataType, T.StringType) else [c]
    groups = df.groupBy(*[k.alias(f"__g{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("__k"))
    agg = groups.agg(F.sum("__k").alias("n"), F.sum(F.col("__k") - 1).alias("d"))
    n, d = F.coalesce(F.col("n"), F.lit(0)), F.coalesce(F.col("d"), F.lit(0))
    return agg.select(F.lit(table).cast("string").alias("table_name"),
                      n.cast("bigint").alias("row_count"),
                      d.cast("bigint").alias("duplicate_row_count"),
                      _pct(d, n).alias("duplicate_row_pct"))


def duplicate_groups(df: DataFrame, cols) -> DataFrame:
    """A5 per group: each repeated value combination with its row count."""
    return (df.groupBy(*[F.col(_q(c)) for c in cols]).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1)
            .withColumn("extra_copies", F.col("row_count") - 1))


def _long_values(df: DataFrame, cols) -> DataFrame:
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(_q(c)).cast("double").alias("value"))
        for c in cols
    ]))).where(F.col("value").isNotNull())


def value_counts(df: DataFrame, cols) -> DataFrame:
    """(column_name, value, n): rows per value of each numeric column, missing ones
    under NULL. One map-side-combined aggregate per column: each reads only its
    own column, and the per-column stages run side by side."""
    df = without_nan(df)
    return reduce(lambda a, b: a.unionByName(b), [
        df.groupBy(F.col(_q(c)).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(c).alias("column_name"), "value", "n") for c in cols])


def exact_quantiles(df: DataFrame, cols, probs=(0.25, 0.5, 0.75), partitions: int | None = None,
                    counts: DataFrame | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (the pandas / quantile_cont rule) of
    several columns, without gathering a column into one task.

    1. count rows per value (``value_counts``, or ``counts`` made by it);
    2. range-partition those distinct values; running counts inside each
       partition plus per-partition offsets give every value's rank interval;
    3. the target ranks (columns x probs x 2 rows) pick the two neighbours and
       interpolate.
    Returns (column_name, prob, value)."""
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = (counts if counts is not None else value_counts(df, cols)).where(F.col("value").isNotNull())
    ranged = counts.repartitionByRange(partitions, "column_name", "value").withColumn(
        "pid", F.spark_partition_id())
    if spark.conf.get("spark.sql.exchange.reuse", "true").lower() != "true":
        # both branches below must see the same range bounds; with exchange
        # reuse on they share one exchange, otherwise materialise it once
        ensure_checkpoint_dir(spark)
        ranged = ranged.checkpoint()
    per_part = ranged.groupBy("column_name", "pid").agg(F.sum("n").alias("pn"))
    w_off = Window.partitionBy("column_name").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    w_tot = Window.partitionBy("column_name")
    offsets = per_part.select(
        "column_name", "pid",
        F.coalesce(F.sum("pn").over(w_off), F.lit(0)).alias("offset"),
        F.sum("pn").over(w_tot).alias("total"))
    w_in = Window.partitionBy("column_name", "pid").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (ranged.withColumn("upto", F.sum("n").over(w_in))
              .join(offsets, ["column_name", "pid"])  # columns x partitions rows: broadcast if they measure small
              .select("column_name", "value", "total",
                      (F.col("offset") + F.col("upto") - F.col("n")).alias("r_start"),
                      (F.col("offset") + F.col("upto")).alias("r_end")))
    # Target ranks: h = (n-1)*q; neighbours floor(h) and min(floor(h)+1, n-1).
    prob_arr = F.array(*[F.lit(float(p)) for p in probs])
    targets = (offsets.select("column_name", "total").distinct()
               .select("column_name", "total", F.explode(prob_arr).alias("prob"))
               .withColumn("h", (F.col("total") - 1) * F.col("prob"))
               .withColumn("r_lo", F.floor("h"))
               .withColumn("r_hi", F.least(F.col("r_lo") + 1, F.col("total") - 1))
               .withColumn("frac", F.col("h") - F.col("r_lo"))
               .drop("total"))
    hit_lo = (F.col("r_start") <= F.col("r_lo")) & (F.col("r_lo") < F.col("r_end"))
    hit_hi = (F.col("r_start") <= F.col("r_hi")) & (F.col("r_hi") < F.col("r_end"))
    picked = ranked.join(F.broadcast(targets), "column_name").where(hit_lo | hit_hi)
    pairs = picked.groupBy("column_name", "prob").agg(
        F.max(F.when(hit_lo, F.col("value"))).alias("lo"),
        F.max(F.when(hit_hi, F.col("value"))).alias("hi"),
        F.first("frac").alias("frac"))
    return pairs.select("column_name", "prob",
                        (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")).alias("value"))


def numeric_summary(df: DataFrame, cols=None, table: str | None = None, exact: bool = True,
                    digits: int | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 %, max — one row per column.
    ``digits`` rounds the output; ``counts`` as in ``exact_quantiles``."""
    df = without_nan(df)
    cols = list(cols) if cols is not None else numeric_columns(df)
    v = [F.col(_q(c)).cast("double") for c in cols]
    wide = df.agg(*[a for i, x in enumerate(v) for a in (
        F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
        F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"))])
    basic = wide.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"n{i}").cast("bigint").alias("count"),
        *[F.col(f"{a}{i}").alias(a) for a in ("mean", "std", "min", "max")]) for i, c in enumerate(cols)])))
    if exact:
        q = exact_quantiles(df, cols, counts=counts)
    else:
        q = _long_values(df, cols).groupBy("column_name").agg(
            F.percentile_approx("value", [0.25, 0.5, 0.75], 10000).alias("qs")).select(
            "column_name", F.posexplode("qs").alias("i", "value")).select(
            "column_name", F.element_at(F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75)]),
                                        F.col("i") + 1).alias("prob"), "value")
    quart = q.groupBy("column_name").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("p25"),
        F.max(F.when(F.col("prob") == 0.5, F.col("value"))).alias("p50"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("p75"))
    r = lambda c: F.col(c) if digits is None else F.round(F.col(c), digits).alias(c)
    return basic.join(quart, "column_name", "left").select(
        F.lit(table).cast("string").alias("table_name"), "column_name", "count",
        r("mean"), r("std"), r("min"), r("p25"), r("p50"), r("p75"), r("max"))


def iqr_outliers(df: DataFrame, cols=None, table: str | None = None, counts: DataFrame | None = None) -> DataFrame:
    """A12 + F5: values strictly outside [q1 - 1.5 IQR, q3 + 1.5 IQR]; the
    percentage is over all rows, missing ones included. The rows are counted on
    the per-value counts the quartiles come from, so the table is not read again."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    counts = counts if counts is not None else value_counts(df, cols)
    q = exact_quantiles(df, cols, probs=(0.25, 0.75), counts=counts).groupBy("column_name").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"))
    fences = q.select("column_name", (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lo"),
                      (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("hi"))
    out = (F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi"))
    found = counts.join(F.broadcast(fences), "column_name", "left").groupBy("column_name").agg(  # a row per column
        F.sum("n").alias("total"), F.sum(F.when(out, F.col("n")).otherwise(0)).alias("o"))
    named = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    n, o = F.coalesce("total", F.lit(0)), F.coalesce("o", F.lit(0))
    return named.join(found, "column_name", "left").select(
        F.lit(table).cast("string").alias("table_name"), "column_name", o.cast("bigint").alias("outlier_count"),
        _pct(o, n).alias("outlier_pct"))


def numeric_like_text(df: DataFrame, cols=None, threshold: float = 0.8) -> DataFrame:
    """A10 + P17: per text column, how many non-NULL trimmed values are plain
    numbers, their share, and the flag (share >= threshold; all-NULL -> false)."""
    cols = list(cols) if cols is not None else string_columns(df)
    aggs = {}
    for i, c in enumerate(cols):
        aggs[f"nn{i}"] = f"count({_q(c)})"
        aggs[f"ok{i}"] = f"count_if(trim(CAST({_q(c)} AS STRING)) RLIKE {_lit(_NUMERIC_RX)})"
    wide = df.agg(*[F.expr(e).alias(a) for a, e in aggs.items()])
    long = _stack(wide, [[_lit(c), f"nn{i}", f"ok{i}"] for i, c in enumerate(cols)],
                  ["column_name", "nn", "ok"])
    return long.selectExpr(
        "column_name", "CAST(nn AS BIGINT) AS non_null_count", "CAST(ok AS BIGINT) AS numeric_count",
        "CASE WHEN nn = 0 THEN CAST(NULL AS DOUBLE) ELSE round(CAST(ok AS DOUBLE) / nn, 6) END AS numeric_share",
        f"CASE WHEN nn = 0 THEN false ELSE CAST(ok AS DOUBLE) / nn >= {float(threshold)}D END AS numeric_like")


def profile(df: DataFrame, table: str, **kw) -> dict[str, DataFrame]:
    """Everything the profiler reports, as DataFrames. Each reads ``df`` when it
    runs, so give it a written table, not a CSV scan (``discovery.profile_file``)."""
    nums = numeric_columns(df)
    out = {
        "overview": dataset_overview(df, table),
        "catalog": column_catalog(df, table),
        "duplicates": duplicate_rows(df, table),
        "columns": column_profile(df, table, **kw),
        "missing_ranking": missing_ranking(missing_counts(df, table)),
    }
    if nums:
        counts = value_counts(df, nums)
        out["numeric_summary"] = numeric_summary(df, nums, table, counts=counts)
        out["outliers"] = iqr_outliers(df, nums, table, counts=counts)
    return out

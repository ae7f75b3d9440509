"""Column profiles that are kept per run and merged, so old runs are never read again.

A run leaves one row a column: counts and classes of values (exact, from
``type_lattice``), an HLL sketch of the distinct values and a KLL sketch of the numbers
(both Spark's own, with a stated error), the least and greatest number. Columns with few
distinct values also leave their value counts, which add up exactly; a column whose
counts were left out in one run, or that outgrows the bound when runs are merged, has
estimates only, and says so.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeq.functions.casts import lenient_double
from lakeq.functions.names import quoted
from lakeq.operators.type_lattice import CLASSES, merge_type_states, type_state

HLL_BITS = 14        # standard error of distinct counts: about 0.8 %
KLL_K = 400          # rank error of quantiles: about 0.7 %
VALUE_BOUND = 1000   # distinct values up to which a column's counts are kept


def column_sketches(df: DataFrame) -> DataFrame:
    """(column_name, distinct_sketch, number_sketch, min_number, max_number) from one aggregate."""
    out, rows = [], []
    for i, (name, kind) in enumerate(df.dtypes):
        text = F.col(quoted(name)).cast("string")
        number = lenient_double(text) if kind == "string" else F.col(quoted(name)).try_cast("double") if kind not in (
            "date", "timestamp", "boolean") else F.lit(None).cast("double")
        number = F.when(~F.isnan(number), number)
        out += [F.hll_sketch_agg(text, HLL_BITS).alias(f"h{i}"), F.kll_sketch_agg_double(number, KLL_K).alias(f"q{i}"),
                F.min(number).alias(f"lo{i}"), F.max(number).alias(f"hi{i}"), F.count(text).alias(f"c{i}")]
        rows.append(F.struct(F.lit(name).alias("column_name"), F.when(F.col(f"c{i}") > 0, F.col(f"h{i}")).alias("distinct_sketch"),
                             F.when(F.col(f"lo{i}").isNotNull(), F.col(f"q{i}")).alias("number_sketch"),
                             F.col(f"lo{i}").alias("min_number"), F.col(f"hi{i}").alias("max_number")))
    return df.agg(*out).select(F.inline(F.array(*rows)))


def run_state(df: DataFrame, run_id: str) -> DataFrame:
    """The profile state of one run: type state and sketches of every column."""
    return type_state(df).join(column_sketches(df), "column_name").withColumn("run_id", F.lit(run_id))


def run_values(df: DataFrame, state: DataFrame, run_id: str, bound: int = VALUE_BOUND) -> DataFrame:
    """(run_id, column_name, value, n) of the columns that hold at most ``bound``
    distinct values by their sketch; the names of these columns are a bounded list (one
    a column of the schema)."""
    few = [r["column_name"] for r in state.where(
        F.coalesce(F.hll_sketch_estimate("distinct_sketch"), F.lit(0)) <= bound).select("column_name").collect()]
    if not few:
        return df.sparkSession.createDataFrame([], "run_id string, column_name string, value string, n long")
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(quoted(c)).cast("string").alias("value")) for c in few])
    return (df.select(F.explode(cells).alias("cell")).select("cell.*").where("value IS NOT NULL")
            .groupBy("column_name", "value").agg(F.count("*").alias("n")).select(F.lit(run_id).alias("run_id"), "*"))


def merge_states(states: DataFrame) -> DataFrame:
    """One row a column from the states of several runs (a table of ``run_state`` rows)."""
    typed = merge_type_states(states.select("position", "column_name", "dtype", "n", "present", *CLASSES))
    merged = states.groupBy("column_name").agg(
        F.count("*").alias("runs"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("number_sketch").alias("number_sketch"),
        F.min("min_number").alias("min_number"), F.max("max_number").alias("max_number"),
        F.count("distinct_sketch").alias("with_values"), F.count("number_sketch").alias("with_numbers"))
    empty = F.lit(None).cast("binary")
    return typed.join(merged, "column_name").withColumns({
        "distinct_sketch": F.when(F.col("with_values") > 0, F.col("distinct_sketch")).otherwise(empty),
        "number_sketch": F.when(F.col("with_numbers") > 0, F.col("number_sketch")).otherwise(empty)}).drop(
        "with_values", "with_numbers")


def merge_values(states: DataFrame, values: DataFrame, bound: int = VALUE_BOUND) -> DataFrame:
    """(column_name, value, n) over all runs, of the columns whose counts every run with
    values has kept and that stay within the bound."""
    kept = values.groupBy("column_name").agg(F.count_distinct("run_id").alias("kept"))
    holding = states.where("present > 0").groupBy("column_name").agg(F.count("*").alias("holding"))
    whole = holding.join(kept, "column_name").where("kept = holding").select("column_name")
    total = values.join(F.broadcast(whole), "column_name").groupBy("column_name", "value").agg(F.sum("n").alias("n"))
    within = total.groupBy("column_name").agg(F.count("*").alias("distinct")).where(F.col("distinct") <= bound)
    return total.join(F.broadcast(within.select("column_name")), "column_name")  # both sides: columns of the schema


def profile_of(merged: DataFrame, values: DataFrame) -> DataFrame:
    """Per column: rows, missing values and share, distinct values (exact where value
    counts are whole, else NULL), their estimate, the most frequent value's count, and
    estimated quartiles of the numbers."""
    exact = values.groupBy("column_name").agg(F.count("*").alias("distinct_values"), F.max("n").alias("most_frequent_count"))
    quartile = lambda q: F.when(F.col("number_sketch").isNotNull(), F.kll_sketch_get_quantile_double(
        "number_sketch", F.lit(q)))
    return merged.join(exact, "column_name", "left").select(
        "column_name", "runs", F.col("n").alias("total_rows"), (F.col("n") - F.col("present")).alias("missing_count"),
        F.when(F.col("n") == 0, F.lit(0.0)).otherwise(
            F.round(100 * (F.col("n") - F.col("present")) / F.col("n"), 2)).alias("missing_percent"),
        "distinct_values", "most_frequent_count",
        F.coalesce(F.hll_sketch_estimate("distinct_sketch"), F.lit(0)).alias("distinct_estimate"),
        "min_number", "max_number", quartile(0.25).alias("q1_estimate"), quartile(0.5).alias("median_estimate"),
        quartile(0.75).alias("q3_estimate"))


def union_states(*states: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, states)

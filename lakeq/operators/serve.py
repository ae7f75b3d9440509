"""C7 dashboard join and the serving metrics M1-M11.

Metrics are group-by aggregates. Decimal measures keep their own scale and
integers stay exact, so their totals do not depend on row order; floating
measures are summed as double. Nothing is rounded here: that is for the caller's
output. Lists of measure columns are aggregated in one wide ``agg`` and unpivoted
afterwards, so the data is never multiplied by the number of measures before the
shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeq.functions.names import quoted
from lakeq.operators.joins import split_join


def _measure(df: DataFrame, c: str) -> Column:
    """A measure as it is summed: exact types as they are, all else as double."""
    exact = isinstance(df.schema[c].dataType, (T.DecimalType, T.IntegralType))
    return F.col(quoted(c)) if exact else F.col(quoted(c)).cast("double")


def _total(df: DataFrame, cols) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(_measure(df, c), F.lit(0)) for c in cols])


def _over(x: Column, y: Column) -> Column:
    return x.cast("double") / F.nullif(y.cast("double"), F.lit(0.0))


def dashboard(fact: DataFrame, dim: DataFrame, key: str, attrs: dict[str, str],
              target_rows: int | None = None) -> DataFrame:
    """Fact rows with aliased dimension attributes (``alias -> column``).

    A USING join keeps one key column (trap T14). AQE broadcasts a dimension that
    measures small and splits a hot provider otherwise. ``target_rows`` keeps
    providers with more rows out of the shuffle (for a dimension that comes out of
    an aggregate, whose join AQE cannot split)."""
    side = dim.select(key, *[F.col(c).alias(a) for a, c in attrs.items()])
    if target_rows is None:
        return fact.join(side, key, "left")
    return split_join(fact, side.where(F.col(key).isNotNull()), [key], "left", target_rows=target_rows)


def hours_by_type(df: DataFrame, measures: dict[str, str]) -> DataFrame:
    """M1: total per measure type (``type name -> column``), as rows."""
    wide = df.agg(*[F.sum(_measure(df, c)).alias(t) for t, c in measures.items()])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("measure_type"), F.col(t).cast("double").alias("total_hours"))
        for t in measures
    ])))


def emp_vs_contract(df: DataFrame, group_cols, emp_cols, ctr_cols) -> DataFrame:
    """M2: employee and contractor sums side by side (never added to totals)."""
    return df.groupBy(*group_cols).agg(
        F.sum(_total(df, emp_cols)).cast("double").alias("emp_hours"),
        F.sum(_total(df, ctr_cols)).cast("double").alias("ctr_hours"))


def rating_by_flag(dim: DataFrame, key: str, flag_col: str, rating_col: str) -> DataFrame:
    """M3 + M4 at dimension grain: average rating and provider count per flag.

    A NULL flag (inferred rows) is its own group."""
    return dim.groupBy(F.col(flag_col).alias("flag")).agg(
        F.avg(F.col(rating_col).try_cast("int")).alias("avg_rating"),
        F.count_distinct(key).alias("provider_count"))


def total_by(df: DataFrame, group_cols, measure_cols) -> DataFrame:
    """M5 / M6: sum of the measure columns per group."""
    return df.groupBy(*group_cols).agg(F.sum(_total(df, measure_cols)).cast("double").alias("total_hours"))


def load_ratio(df: DataFrame, key: str, hours_cols, load: Column) -> DataFrame:
    """M8: hours over load per key; load 0 gives NULL."""
    return df.groupBy(key).agg(
        F.sum(_total(df, hours_cols)).cast("double").alias("total_hours"),
        load.cast("double").alias("load"),
    ).withColumn("ratio", _over(F.col("total_hours"), F.col("load")))


def occupancy(df: DataFrame, key: str, census_col: str, dim: DataFrame, beds_col: str) -> DataFrame:
    """M7: a provider's average census over its beds; no or zero beds give NULL.

    The fact is reduced to one row per provider before the join."""
    x = _measure(df, census_col)  # sum over count: the average of a decimal would be cut to its scale
    census = df.groupBy(key).agg((F.sum(x).cast("double") / F.nullif(F.count(x), F.lit(0))).alias("avg_census"))
    beds = dim.select(key, F.col(beds_col).try_cast("double").alias("beds"))
    return census.join(beds, key, "left").withColumn("occupancy", _over(F.col("avg_census"), F.col("beds")))


def bottom_k(df: DataFrame, order_col: str, tie_cols, k: int) -> DataFrame:
    """O2: the k smallest rows; planned as a distributed top-k (TakeOrderedAndProject)."""
    return df.orderBy(F.col(order_col).asc_nulls_last(), *[F.col(c).asc() for c in tie_cols]).limit(k)


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """M9: Pearson correlation of two measures (after a J6 join); NULL if one of them
    does not vary (``corr`` itself raises on that under ANSI)."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    a, b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return df.agg(F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)).alias("correlation"),
                  F.count(F.lit(1)).alias("n_pairs"))


def perm_vs_contract(df: DataFrame, group_cols, emp_cols, ctr_cols, load_col: str) -> DataFrame:
    """Permanent / contract ratio, and each per unit of load."""
    g = df.groupBy(*group_cols).agg(
        F.sum(_total(df, emp_cols)).alias("e"), F.sum(_total(df, ctr_cols)).alias("c"),
        F.sum(_measure(df, load_col)).alias("l"))
    return g.select(*group_cols,
                    F.col("e").cast("double").alias("emp_hours"),
                    F.col("c").cast("double").alias("ctr_hours"),
                    _over(F.col("e"), F.col("c")).alias("emp_ctr_ratio"),
                    _over(F.col("e"), F.col("l")).alias("emp_per_load"),
                    _over(F.col("c"), F.col("l")).alias("ctr_per_load"))


def reference_gap(fact: DataFrame, fact_key: str, ref: DataFrame, ref_key: str) -> DataFrame:
    """Fact rows without a reference row, and how many distinct keys they carry."""
    # no distinct before an anti join: it cannot multiply rows, and a plain
    # shuffle on both inputs lets AQE split a hot fact key
    keys = ref.select(F.col(ref_key).alias("__lq_k"))
    orphans = fact.join(keys, fact[fact_key] == keys["__lq_k"], "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("unmatched_rows"),
                       F.count_distinct(fact_key).alias("unmatched_keys"))


def contract_view(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """Serve a table under its declared contract: columns resolved by name, in
    declared order (D4), cast to the declared type (D1); declared columns the
    table lacks become typed NULLs (P10); undeclared ones are not served (D3)."""
    have = set(df.columns)
    return df.select([(F.col(c).cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in columns])


def fact_view(fact: DataFrame, dim: DataFrame, key: str, flag_columns, columns: list[tuple[str, str]],
              parity: bool = False, target_rows: int | None = None) -> DataFrame:
    """The declared fact view. The provider-match flags are joined from the
    dimension (``target_rows`` as in ``dashboard``); ``parity=True`` serves them as
    NULL, as the source pipeline's fact table did."""
    if not parity:
        side = dim.select(key, *flag_columns)
        fact = (fact.drop(*[f for f in flag_columns if f in fact.columns])
                .transform(lambda f: f.join(side, key, "left") if target_rows is None else split_join(
                    f, side.where(F.col(key).isNotNull()), [key], "left", target_rows=target_rows)))
    return contract_view(fact, columns)

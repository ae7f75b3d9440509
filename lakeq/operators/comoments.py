"""J6 / M9 over many measures: co-moments of all pairs as a state that merges over runs.

A run's state has one row per pair of measures: how many rows have both, their means,
squared deviations and cross deviations. One pass over the run gives all pairs; states
of several runs merge without reading the runs again, and correlations, covariances
and regression slopes follow from the merged state. Means and deviations (not raw
sums and squares) are kept, so large values do not cancel beyond the precision of a mean.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeq.functions.names import quoted


def _value(df: DataFrame, c: str) -> Column:
    x = F.col(quoted(c)).cast("double")
    return F.when(~F.isnan(x), x)  # NaN is missing, as in profiles


def pair_state(df: DataFrame, measures) -> DataFrame:
    """(x, y, n, mean_x, mean_y, dev_x, dev_y, dev_xy) for each pair x < y in the order
    given; rows lacking one of the two do not count for a pair. An empty input has n = 0."""
    pairs = list(combinations(list(measures), 2))
    columns = []
    for i, (x, y) in enumerate(pairs):
        both = _value(df, x).isNotNull() & _value(df, y).isNotNull()
        a, b = F.when(both, _value(df, x)), F.when(both, _value(df, y))
        columns.append(F.struct(
            F.lit(x).alias("x"), F.lit(y).alias("y"), F.count(a).alias("n"),
            F.avg(a).alias("mean_x"), F.avg(b).alias("mean_y"),
            (F.var_pop(a) * F.count(a)).alias("dev_x"), (F.var_pop(b) * F.count(a)).alias("dev_y"),
            (F.covar_pop(a, b) * F.count(a)).alias("dev_xy")).alias(f"p{i}"))
    return df.agg(*columns).select(F.inline(F.array(*[F.col(f"p{i}") for i in range(len(pairs))])))


def merge_states(states: DataFrame) -> DataFrame:
    """One row per pair over all runs: deviations from the common mean are those within
    the runs plus those of the runs' means."""
    pair, some = ["x", "y"], states.where(F.col("n") > 0)
    common = some.groupBy(*pair).agg(
        F.sum("n").alias("total"), (F.sum(F.col("mean_x") * F.col("n")) / F.sum("n")).alias("cx"),
        (F.sum(F.col("mean_y") * F.col("n")) / F.sum("n")).alias("cy"))
    dx, dy = F.col("mean_x") - F.col("cx"), F.col("mean_y") - F.col("cy")
    return some.join(common, pair).groupBy(*pair).agg(
        F.first("total").alias("n"), F.first("cx").alias("mean_x"), F.first("cy").alias("mean_y"),
        F.sum(F.col("dev_x") + F.col("n") * dx * dx).alias("dev_x"),
        F.sum(F.col("dev_y") + F.col("n") * dy * dy).alias("dev_y"),
        F.sum(F.col("dev_xy") + F.col("n") * dx * dy).alias("dev_xy"))


def correlations(state: DataFrame) -> DataFrame:
    """(x, y, n_pairs, correlation): NULL where a measure does not vary."""
    return state.select("x", "y", F.col("n").alias("n_pairs"), F.try_divide(
        F.col("dev_xy"), F.sqrt("dev_x") * F.sqrt("dev_y")).alias("correlation"))

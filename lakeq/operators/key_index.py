"""F3 / J1 / A14 over runs: an index of the keys of accepted runs.

The index is a catalog table with one row per run and key, partitioned by run and
bucketed by the key. A new run is checked against all earlier ones by a join that
moves only the new run's distinct keys: the buckets of the index are read where
they lie, so its size does not decide what is shuffled. Adding a run again replaces
its own partition and no other, so a repeated run changes nothing.

Keys with a NULL part never repeat (trap T7) and are not in the index.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeq.functions.names import quoted
from lakeq.operators.joins import _N, DEFAULT_TARGET_ROWS, key_counts, split_join


def create_key_index(spark: SparkSession, name: str, path: str, keys: dict[str, str], buckets: int) -> None:
    """An empty index for the keys (column -> type) in ``buckets`` buckets. Take at least
    as many as the session has shuffle partitions, and so many that a bucket of all
    runs together fits a task."""
    columns = ", ".join(f"{quoted(k)} {t}" for k, t in keys.items())
    by = ", ".join(quoted(k) for k in keys)
    spark.sql(f"CREATE TABLE {name} ({columns}, copies BIGINT, run_id STRING) USING parquet PARTITIONED BY (run_id) "
              f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")


def _complete(keys) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _indexed_keys(spark: SparkSession, name: str) -> dict[str, str]:
    return {c: t for c, t in spark.table(name).dtypes if c not in ("copies", "run_id")}


def _buckets(spark: SparkSession, name: str) -> int:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return int(described.where(F.col("col_name") == "Num Buckets").first()["data_type"])


def _run_counts(df: DataFrame, keys: dict[str, str]) -> DataFrame:
    """(keys..., __lq_n): rows per complete key, in the types of the index."""
    return key_counts(df.where(_complete(keys)).select(*[F.col(k).cast(t).alias(k) for k, t in keys.items()]), list(keys))


def add_run(df: DataFrame, name: str, run_id: str) -> None:
    """Put the keys of one run into the index, each bucket written by one task."""
    spark = df.sparkSession
    keys = _indexed_keys(spark, name)
    counts = _run_counts(df, keys).repartition(_buckets(spark, name), *keys)
    by = ", ".join(quoted(k) for k in keys)
    if not re.fullmatch(r"[\w.:+-]+", run_id):
        raise ValueError(f"run id {run_id!r} is not made of letters, digits and . : + - _")
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (run_id = '{run_id}') SELECT {by}, {_N} FROM {{counts}}",
              counts=counts)


def seen_keys(df: DataFrame, name: str, run_id: str) -> DataFrame:
    """Keys of a run that repeat in it or occur in another run of the index:
    (keys..., run_copies, prior_copies, first_run). The run's own rows of the index, if
    it has been added before, do not count; ``first_run`` is the least run id."""
    spark = df.sparkSession
    keys = _indexed_keys(spark, name)
    prior = (spark.table(name).where(F.col("run_id") != run_id).groupBy(*keys)
             .agg(F.sum("copies").alias("prior_copies"), F.min("run_id").alias("first_run")))
    new = _run_counts(df, keys).withColumnRenamed(_N, "run_copies").repartition(_buckets(spark, name), *keys)
    return (new.join(prior, list(keys), "left")
            .where((F.col("run_copies") > 1) | F.col("prior_copies").isNotNull())
            .withColumn("prior_copies", F.coalesce("prior_copies", F.lit(0))))


def duplicates_against_history(df: DataFrame, name: str, run_id: str,
                               target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Every row of a run whose key repeats in the run or was accepted with another one,
    with the columns of ``seen_keys``. Rows of hot keys stay out of the shuffle."""
    keys = list(_indexed_keys(df.sparkSession, name))
    return split_join(df, seen_keys(df, name, run_id), keys, "inner", counts=key_counts(df.where(_complete(keys)), keys),
                      target_rows=target_rows)

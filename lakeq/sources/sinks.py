"""Parquet sinks and catalog tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def run_path(base: str, run_id: str) -> str:
    return f"{base.rstrip('/')}/run_id={run_id}"


def write_run(df: DataFrame, base: str, run_id: str) -> str:
    """Overwrite one run's directory."""
    path = run_path(base, run_id)
    df.write.mode("overwrite").parquet(path)
    return path


def read_run(spark: SparkSession, base: str, run_id: str) -> DataFrame:
    """S3 / F8: one run's rows, read from its directory."""
    return spark.read.parquet(run_path(base, run_id))


def write_partitioned(df: DataFrame, path: str, partition_cols=("work_year", "work_month"),
                      dynamic: bool = False, rebalance: bool = True) -> None:
    """Partitioned parquet. Static overwrite (parity) replaces the whole
    table; ``dynamic=True`` replaces only the partitions present (trap T8).

    ``rebalance`` shuffles rows by the partition columns with AQE allowed to
    split a hot partition and merge small ones, so each directory gets a few
    right-sized files instead of one file per input task per directory."""
    if rebalance:
        df = df.hint("rebalance", *partition_cols)
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .partitionBy(*partition_cols).parquet(path))


def write_table(df: DataFrame, path: str) -> None:
    """Unpartitioned overwrite (dimension)."""
    df.write.mode("overwrite").parquet(path)


def write_quarantine(rows: DataFrame, base: str, table: str, run_id: str, rebalance: bool = True) -> str:
    """Quarantined rows of one table and run, partitioned by reason.

    The run's directory is always overwritten, also with no rows, so an old bad
    row cannot outlive a clean rerun (trap T16); reason and run live in the path
    only (trap T15).

    ``rebalance`` as in S8: a few right-sized files per reason, not one per task and
    reason. Rows scanned from written files need none, as the scan sizes the tasks."""
    path = f"{base.rstrip('/')}/{table}/run_id={run_id}"
    rows = rows.drop("run_id")
    if rebalance:
        rows = rows.hint("rebalance", "quarantine_reason")
    (rows.write.mode("overwrite").partitionBy("quarantine_reason").parquet(path))
    return path


def register_table(spark: SparkSession, name: str, path: str, schema_ddl: str | None = None,
                   partition_cols=()) -> None:
    """A catalog table over parquet at a path that is not written again.
    The entry is made anew, so it has the schema of the files; partitions are
    synchronised with the directories, gone ones included."""
    cols = f"({schema_ddl})" if schema_ddl else ""
    # with no column list, the partition columns are inferred from the directory layout
    parts = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols and schema_ddl else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay
    spark.sql(f"CREATE TABLE {name} {cols} USING parquet{parts} LOCATION '{path}'")
    if partition_cols:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def publish(spark: SparkSession, name: str, path: str, run_id: str, schema_ddl: str | None = None,
            partition_cols=(), attempt: str = "1") -> str:
    """Publish one attempt of a run: register its table under a name of its own,
    then point the stable name (a view) at it. An attempt has a fresh directory, so
    tables that readers use are never written to, and replacing a view is one
    catalog update: readers see the old attempt or the new one (trap T19). Views of
    several tables still move one after the other. Returns the attempt's table name."""
    table = f"{name}__{re.sub(r'[^0-9A-Za-z_]', '_', run_id)}__{re.sub(r'[^0-9A-Za-z_]', '_', attempt)}"
    register_table(spark, table, path, schema_ddl, partition_cols)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {table}")
    return table

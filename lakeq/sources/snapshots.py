"""Bucketed serving tables, and one commit record for several of them.

``write_serving`` writes an attempt of a fact and its dimension in equal buckets of the
key, so the dashboard join (J5) reads both without a shuffle. A key with very many rows
is dealt over ``slice`` numbers and its dimension row repeated for each, so that no
bucket holds it whole.

``commit`` names the attempts that belong together in one view, which the catalog
replaces at once; ``open_snapshot`` takes all tables from one reading of it. A run that
dies between two tables has committed nothing, and readers never see a mixed pair.
The last ``keep`` commits stay on record for readers that are still at work;
``expire`` removes attempts that none of them names. One writer commits at a time.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeq.operators.joins import _N, DEFAULT_TARGET_ROWS, MAX_HOT, key_counts

SLICE = "slice"


def _hot_slices(fact: DataFrame, key: str, target_rows: int) -> DataFrame:
    """(hot_key, slices) of the most frequent keys above ``target_rows`` rows, NULL included;
    MAX_HOT rows at most, so that any other key has under a MAX_HOT-th of the rows."""
    hot = key_counts(fact, [key]).where(F.col(_N) > target_rows).orderBy(F.desc(_N), key).limit(MAX_HOT)
    return hot.select(F.col(key).alias("hot_key"), F.ceil(F.col(_N) / target_rows).cast("int").alias("slices"))


def with_slices(fact: DataFrame, dim: DataFrame, key: str,
                target_rows: int = DEFAULT_TARGET_ROWS) -> tuple[DataFrame, DataFrame]:
    """Both tables with a column ``slice``; (key, slice) joins as key does. A row's slice
    comes from its values and its input partition, which a repeated task has again, so
    equal rows are spread too."""
    if SLICE in fact.columns or SLICE in dim.columns:
        raise ValueError(f"a column named {SLICE!r} is already there")
    hot = F.broadcast(_hot_slices(fact, key, target_rows))
    dealt = F.pmod(F.xxhash64(*fact.columns, F.spark_partition_id()), F.col("slices"))
    sliced = (fact.withColumn(SLICE, F.lit(0)).join(hot, F.col(key).eqNullSafe(F.col("hot_key")), "left")
              .withColumn(SLICE, F.coalesce(dealt, F.lit(0)).cast("int")).select(*fact.columns, SLICE))
    # a NULL key has no dimension row, so plain equality will do
    numbers = F.sequence(F.lit(0), F.coalesce(F.col("slices"), F.lit(1)) - 1)
    repeated = (dim.join(hot, F.col(key) == F.col("hot_key"), "left")
                .select(*dim.columns, F.explode(numbers).alias(SLICE)))
    return sliced, repeated


def write_bucketed(df: DataFrame, name: str, path: str, keys, buckets: int, partition_cols=()) -> str:
    """A catalog table at a fresh path, sorted in ``buckets`` buckets of ``keys``, each
    bucket written by one task (one file for each directory it has rows of)."""
    keys = list(keys)
    writer = (df.repartition(buckets, *keys).write.mode("errorifexists").format("parquet")
              .bucketBy(buckets, *keys).sortBy(*keys).option("path", path))
    (writer.partitionBy(*partition_cols) if partition_cols else writer).saveAsTable(name)
    return name


def attempt_name(name: str, attempt: str) -> str:
    return f"{name}__{re.sub(r'[^0-9A-Za-z_]', '_', attempt)}"


def write_serving(fact: DataFrame, dim: DataFrame, *, key: str, fact_name: str, dim_name: str, base: str, attempt: str,
                  buckets: int, partition_cols=(), target_rows: int = DEFAULT_TARGET_ROWS) -> dict[str, str]:
    """One attempt of both tables in equal buckets of (key, slice); returns
    {name: attempt's table}, which is what ``commit`` takes. Nothing is visible yet."""
    sliced, repeated = with_slices(fact, dim, key, target_rows)
    names = {n: attempt_name(n, attempt) for n in (fact_name, dim_name)}
    root = base.rstrip("/")
    write_bucketed(sliced, names[fact_name], f"{root}/{names[fact_name]}", (key, SLICE), buckets, partition_cols)
    write_bucketed(repeated, names[dim_name], f"{root}/{names[dim_name]}", (key, SLICE), buckets)
    return names


def dashboard(fact: DataFrame, dim: DataFrame, key: str, attrs: dict[str, str]) -> DataFrame:
    """J5 over serving tables: fact rows with dimension attributes (``alias -> column``);
    no row is shuffled, since both sides have the buckets of (key, slice)."""
    side = dim.select(key, SLICE, *[F.col(c).alias(a) for a, c in attrs.items()])
    return fact.join(side, [key, SLICE], "left").drop(SLICE)


def _records(spark: SparkSession, snapshot: str) -> list:
    """The commits on record (a row for each table of the last few), none before the first."""
    return spark.table(snapshot).collect() if spark.catalog.tableExists(snapshot) else []


def commit(spark: SparkSession, snapshot: str, tables: dict[str, str], keep: int = 2) -> int:
    """Make the attempts (name -> its table) the current ones, all at once. Returns the
    number of the commit; ``keep`` commits, this one included, stay on record."""
    for table in tables.values():
        if not spark.catalog.tableExists(table):
            raise ValueError(f"{table} is not a table of the catalog")
    earlier = _records(spark, snapshot)
    number = max((r["commit"] for r in earlier), default=0) + 1
    rows = [(r["commit"], r["name"], r["attempt"]) for r in earlier if r["commit"] > number - keep]
    rows += [(number, n, t) for n, t in tables.items()]
    values = ", ".join(f"({c}, '{n}', '{t}')" for c, n, t in rows)
    spark.sql(f"CREATE OR REPLACE VIEW {snapshot} AS SELECT * FROM VALUES {values} AS t(commit, name, attempt)")
    return number


def committed(spark: SparkSession, snapshot: str) -> dict[str, str]:
    """{name: attempt's table} of the last commit."""
    rows = _records(spark, snapshot)
    last = max((r["commit"] for r in rows), default=0)
    return {r["name"]: r["attempt"] for r in rows if r["commit"] == last}


def open_snapshot(spark: SparkSession, snapshot: str) -> dict[str, DataFrame]:
    """All tables of the last commit, from one reading of the record."""
    return {name: spark.table(table) for name, table in committed(spark, snapshot).items()}


def expire(spark: SparkSession, snapshot: str, names) -> list[str]:
    """Remove the attempts of ``names`` that no commit on record names, files included (those
    of runs that failed before their commit too). Not to be run while one is being written."""
    named = {r["attempt"] for r in _records(spark, snapshot)}
    gone = []
    for name in names:
        attempts = [t.name for t in spark.catalog.listTables(pattern=f"{name}__*")
                    if t.name.startswith(f"{name}__") and t.name not in named]
        for table in attempts:
            described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Location")
            location = spark._jvm.org.apache.hadoop.fs.Path(described.first()["data_type"])
            spark.sql(f"DROP TABLE {table}")
            location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
            gone.append(table)
    return gone

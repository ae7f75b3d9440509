"""Scratch tables and small guards shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeq.session import scratch_path

# A table may be broadcast only when a count has shown it to be at most this long;
# THIN_ROWS holds for rows of a few numbers (about 20 MB).
BROADCAST_ROWS = 10_000
THIN_ROWS = 250_000

# Rows of one Arrow batch of texts: with Spark's default of 10,000 a batch of long
# documents would take gigabytes.
TEXT_BATCH = 512


def text_batches(spark: SparkSession) -> None:
    """From now on this session hands texts to Python in batches of TEXT_BATCH rows."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > TEXT_BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH))


def at_most(df: DataFrame, rows: int) -> bool:
    """Has the table at most so many rows? (Reads no further.)"""
    return df.limit(rows + 1).count() <= rows


def free_names(df: DataFrame, *names: str) -> tuple[str, ...]:
    """Each name, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


class Scratch:
    """Parquet tables under the shared ``spark.checkpoint.dir``.

    Writing a step cuts its lineage: a lost executor repeats only what came
    after the last written table. ``drop`` deletes tables that no later step reads,
    ``finish`` all but those that the result reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.n = spark, scratch_path(spark, name), 0
        self.paths: list[str] = []

    def table(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """``by``: a column with a folder for each value."""
        self.n += 1
        path = f"{self.base}/{self.n:03d}-{name}"
        df.write.mode("overwrite").partitionBy(*[by] if by else []).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        self.paths.append(path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        self._delete([t._scratch_path for t in tables])

    def finish(self, *kept: DataFrame) -> None:
        self._delete([p for p in self.paths if p not in {t._scratch_path for t in kept}])

    def _delete(self, paths: list[str]) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for p in paths:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(conf).delete(path, True)
            self.paths.remove(p)


def parallelism(spark: SparkSession) -> int:
    """Tasks of a shuffle in this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

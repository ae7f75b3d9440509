"""Which files have been published, by content, and which stages are done.

A file is known by its dataset and digest, not by name and size: a change that keeps
the size is new, a file that only moved is not. The digest is made from the size, the
number of lines and two sums over hashes of the lines, so that a file of any size is
read in splits by many tasks; lines in another order are the same rows.

Ledger rows lie under ``run_id=/state=``: a run that is repeated replaces its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STATES = ("pending", "landed", "published")
FILE_COLUMNS = "dataset string, path string, size_bytes bigint, digest string, refined_run string, at timestamp"


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def file_digests(spark: SparkSession, paths) -> DataFrame:
    """(path, size_bytes, lines, digest) of each text file under ``paths``; no file may be
    under two of them. Spark lists no empty files."""
    listed = spark.read.format("binaryFile").load(paths).select(  # content is not read
        F.col("_metadata.file_path").alias("encoded"), "path", F.col("length").alias("size_bytes"))
    h = F.sha2(F.col("value"), 256)

    def lane(start: int) -> Column:  # 60 bits; a sum over 10**18 lines fits decimal(38)
        return F.sum(F.conv(F.substring(h, start, 15), 16, 10).cast("decimal(20,0)"))
    sums = (spark.read.text(paths).select(F.col("_metadata.file_path").alias("encoded"), "value")
            .groupBy("encoded").agg(F.count(F.lit(1)).alias("lines"), lane(1).alias("a"), lane(16).alias("b")))
    digest = F.sha2(F.concat_ws(":", *[F.col(c).cast("string") for c in ("size_bytes", "lines", "a", "b")]), 256)
    return listed.join(sums, "encoded").select("path", "size_bytes", "lines", digest.alias("digest"))


def _plain(path: Column) -> Column:
    """Paths of the local file system with and without scheme alike."""
    return F.regexp_replace(path, "^file:/+", "/")


def with_digests(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Manifest rows with the ``digest`` of their file: NULL where the path is a folder or an
    empty file, which then counts as new each time. The paths of one run are listed."""
    paths = {r["path"] for r in manifest.select("path").distinct().collect()}
    none = manifest.withColumn("digest", F.lit(None).cast("string"))
    if not paths:
        return none
    # each file once, also where it is named twice or a folder around it is
    listed = spark.read.format("binaryFile").load(sorted(paths)).select("path").distinct()
    wanted = manifest.select(_plain(F.col("path")).alias("wanted")).distinct()
    files = [r["path"] for r in listed.join(wanted, _plain(F.col("path")) == F.col("wanted"), "left_semi").collect()]
    if not files:
        return none
    found = file_digests(spark, files).select(_plain(F.col("path")).alias("__lq_path"), "digest")
    return manifest.join(found, _plain(F.col("path")) == F.col("__lq_path"), "left").drop("__lq_path")


def record_files(entries: DataFrame, base: str, run_id: str, state: str) -> None:
    """Put a run's files (columns of FILE_COLUMNS) into the ledger under a state."""
    if state not in STATES:
        raise ValueError(f"state {state!r} is not one of {', '.join(STATES)}")
    names = [c.split()[0] for c in FILE_COLUMNS.split(", ")]
    entries.select(*names).write.mode("overwrite").parquet(f"{base.rstrip('/')}/run_id={run_id}/state={state}")


def read_files(spark: SparkSession, base: str) -> DataFrame:
    """The ledger's rows with run_id and state; none before the first."""
    schema = f"{FILE_COLUMNS}, run_id string, state string"
    if not path_exists(spark, base):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(base)


def known_files(entries: DataFrame, ledger: DataFrame, state: str = "published") -> DataFrame:
    """``entries`` (with dataset and digest) and, where a run has brought the same content of
    the dataset to ``state``, the last such run (``known_run``) and the run whose refined
    rows it used (``refined_run``). Rows without ``known_run`` are still to be done."""
    last = ledger.where((F.col("state") == state) & F.col("digest").isNotNull()).groupBy("dataset", "digest").agg(
        F.max_by(F.struct(F.col("run_id").alias("known_run"), "refined_run"), F.struct("at", "run_id")).alias("__lq_r"))
    return entries.join(last, ["dataset", "digest"], "left").select(*[c for c in entries.columns], "__lq_r.*")


def record_stage(spark: SparkSession, base: str, run_id: str, stage: str, record: str, follows: str) -> None:
    """Note a finished stage: its record's id and that of the record it builds on."""
    spark.createDataFrame([(record, follows)], "record string, follows string").coalesce(1).write.mode("overwrite").json(
        f"{base.rstrip('/')}/run_id={run_id}/stage={stage}")


def read_stages(spark: SparkSession, base: str) -> DataFrame:
    """(run_id, stage) of every stage that a run has finished."""
    return spark.read.schema("run_id string, stage string").json(base).select("run_id", "stage")


def finished_stages(spark: SparkSession, base: str, run_id: str, stages, inputs: str) -> tuple[list[str], str]:
    """The leading stages of a run that are done for these inputs, and the last record's id.
    A record counts only if it builds on the record before it, so what followed an
    earlier attempt of a stage does not."""
    path = f"{base.rstrip('/')}/run_id={run_id}"
    if not path_exists(spark, path):
        return [], inputs
    rows = {r["stage"]: r for r in spark.read.schema("record string, follows string, stage string").json(path).collect()}
    done, last = [], inputs
    for stage in stages:
        if stage not in rows or rows[stage]["follows"] != last:
            break
        done.append(stage)
        last = rows[stage]["record"]
    return done, last

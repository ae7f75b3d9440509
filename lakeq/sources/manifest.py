"""Manifests of landed files.

A manifest here is a table — one row per landed file with its run — rather
than one JSON document per run, so listing, selecting and skipping files are
plain DataFrame operations at any file count. The nested single-document form
is still read (``read_manifest_document``) and written (``write_manifest_document``)
for parity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeq.functions.text import clean_file_name

MANIFEST_COLUMNS = ("run_id", "source", "dataset", "file_id", "file_name", "path", "size_bytes")


def manifest_records(df: DataFrame, *, run_id, dataset, file_id, file_name, path, size_bytes,
                     source: str = "landing", pos=None) -> DataFrame:
    """S5 + S6: normalise any listing into manifest rows; names are cleaned.
    ``pos`` is the entry's number in its run, which "the last entry wins" goes by."""
    def as_col(x):
        return x if not isinstance(x, str) else F.col(x)
    return df.select(
        F.lit(run_id).alias("run_id") if isinstance(run_id, str) else run_id.alias("run_id"),
        F.lit(source).alias("source"),
        as_col(dataset).cast("string").alias("dataset"),
        as_col(file_id).cast("string").alias("file_id"),
        clean_file_name(as_col(file_name)).alias("file_name"),
        as_col(path).cast("string").alias("path"),
        as_col(size_bytes).cast("bigint").alias("size_bytes"),
        *([] if pos is None else [as_col(pos).cast("bigint").alias("pos")]))


def manifest_from_files(spark: SparkSession, pattern: str, *, run_id: str, dataset=None) -> DataFrame:
    """S5 over a file system: path and length only; file contents are not read
    (the binary-file source prunes the content column)."""
    listing = spark.read.format("binaryFile").load(pattern).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    ds = F.lit(dataset) if isinstance(dataset, str) else F.regexp_replace(name, r"\.[^.]*$", "")
    return manifest_records(listing, run_id=run_id, dataset=ds, file_id=F.col("path"),
                            file_name=name, path="path", size_bytes="length")


def write_manifest(manifest: DataFrame, base: str) -> None:
    """Put a run's rows into the manifest table (partitioned by run). A run that is
    written again replaces its own rows and no others."""
    (manifest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").json(base))


def read_manifest_document(spark: SparkSession, path: str) -> DataFrame:
    """S4 input: the nested form {run_id, source, timestamp, files: [...]}, one
    row per file with its position (for 'last entry wins')."""
    doc = spark.read.option("multiLine", True).json(path)
    return doc.select("run_id", "source", F.posexplode("files").alias("pos", "f")).select(
        "run_id", "source", "pos", "f.dataset", "f.file_id", "f.file_name",
        F.col("f.s3_path").alias("path"), F.col("f.size_bytes").cast("bigint").alias("size_bytes"))


def write_manifest_document(manifest: DataFrame, path: str, timestamp: str) -> None:
    """The nested per-run document. Each run becomes one record, so use this
    only for runs with a bounded number of files (a run lists its landed files).
    Entries keep the order of ``pos`` (without it: of path)."""
    order = F.col("pos") if "pos" in manifest.columns else F.col("path")
    entry = F.struct("dataset", "file_id", "file_name", F.col("path").alias("s3_path"), "size_bytes")
    files = F.array_sort(F.collect_list(F.struct(order.alias("o"), entry.alias("e"))))
    (manifest.groupBy("run_id", "source").agg(F.transform(files, lambda x: x["e"]).alias("files"))
     .withColumn("timestamp", F.lit(timestamp))
     .write.mode("overwrite").json(path))


def last_entries(manifest: DataFrame) -> DataFrame:
    """Of each dataset's entries the one with the largest ``pos``."""
    if "pos" not in manifest.columns:
        raise ValueError("the manifest has no entry numbers (pos), so its last entries are not known")
    return manifest.groupBy("dataset").agg(F.max_by(F.struct(*manifest.columns), "pos").alias("r")).select("r.*")


def select_dataset_file(manifest: DataFrame, dataset: str) -> dict:
    """The record for one dataset; the last entry wins; error when absent.
    Collects one row (bounded)."""
    rows = last_entries(manifest.where(F.col("dataset") == dataset)).collect()
    if not rows:
        raise ValueError(f"dataset {dataset!r} has no entry in the manifest")
    return rows[0].asDict()


def pending_files(manifest: DataFrame, processed: DataFrame) -> DataFrame:
    """Files of a new manifest not already processed, matched on
    (dataset, path, size) — a changed size counts as a new file."""
    keys = ["dataset", "path", "size_bytes"]
    return manifest.join(processed.select(*keys), keys, "left_anti")

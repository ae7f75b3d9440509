"""Corpus pipeline over ``documents``: quality, line dedup, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; ``run`` writes every stage's result as Parquet in the shared scratch folder
and reads it again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeq.llm import jaccard, line_dedup, mixing, packing, quality, queries
from lakeq.llm.common import Scratch, free_names


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    score, = free_names(docs, "quality_score")
    scored = quality.score(docs, quality.train(docs, labels), out=score)
    return scored.where(F.col(score) >= quality.KEEP_FROM).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; a document of which no word is left goes."""
    lines, removed = free_names(docs, "lines", "removed")
    cleaned = line_dedup.drop_copied_lines(docs, counts=(lines, removed))
    changed = F.col(removed) > 0
    return (cleaned.where(~changed | F.col("text").rlike(r"\S"))
            .withColumn("n_chars", F.when(changed, F.char_length("text")).otherwise(F.col("n_chars")).cast("long"))
            .select(*docs.columns))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component under Jaccard >= 0.8 of 5-word shingles."""
    return jaccard.first_of_components(docs, jaccard.join_documents(docs, k=5, percent=80))


def poisson_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents in the target mix of sources, globally shuffled."""
    return mixing.mix_sources(docs, queries.SOURCE_WEIGHTS, seed=queries.MIX_SEED,
                              made=free_names(docs, "copy", "copies")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their bins."""
    return packing.pack(docs, queries.CAPACITIES)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("poisson_mixing", poisson_mixing),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None  # training, suffix ranks and packing are beyond SQL; tests/llm has brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        read, docs = docs, scratch.table(stage(spark, docs, sf_dir), name)
        if number:  # the stage before is not read again
            scratch.drop(read)
    return docs

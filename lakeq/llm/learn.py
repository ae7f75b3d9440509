"""Bounded labelled samples and one-task training shared by the two text models."""

from __future__ import annotations

import pickle
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeq.llm.common import BROADCAST_ROWS


SALTS = 64


def fold(id_col: str, k: int) -> Column:
    """crc32 of the id's text modulo k; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % k


def sample_ids(labelled: DataFrame, per_target: int) -> DataFrame:
    """Of (doc_id, target), the ``per_target`` ids of each target that come first
    in hash order. The rank limit is applied before each shuffle, and first by target
    and salt, so a frequent target is never gathered."""
    out = labelled.where("doc_id is not null and target is not null").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SALTS)))
    for keys in (["target", "salt"], ["target"]):
        w = W.partitionBy(*keys).orderBy(F.xxhash64("doc_id"), "doc_id")
        out = out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= per_target).drop("rank")
    return out.drop("salt")


def with_text(ids: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, target, text) of sampled ids, one row per id. The ids are broadcast
    when a count shows that they are few, as their bound makes them."""
    few = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (texts.join(F.broadcast(ids) if few else ids, "doc_id").groupBy("doc_id")
            .agg(F.max("target").alias("target"), F.max("text").alias("text")))


def train(sample: DataFrame, fit: Callable[[list, pa.ChunkedArray], object]) -> object:
    """Run ``fit(targets, texts)`` in one task over the bounded sample, in hash
    order, and return what it returns (a model of bounded size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(list(batches), schema=schema)
        model = fit(got["target"].to_pylist(), got["text"])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.large_binary())], names=["model"])

    target = sample.schema["target"].dataType.simpleString()
    schema = pa.schema([("target", pa.int32() if target == "int" else pa.string()), ("text", pa.string())])
    one = (sample.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").select("target", "text"))
    rows = one.mapInArrow(run, "model binary").collect()
    return pickle.loads(rows[0]["model"]) if rows else fit([], pa.chunked_array([], pa.string()))


class Bags:
    """Feature buckets and their shares of every sampled document, in two buffers
    that grow in place (many small arrays would stay with the worker)."""

    def __init__(self):
        self.ids, self.shares, self.ends = array("i"), array("f"), [0]

    def add(self, buckets: np.ndarray) -> None:
        ids, count = np.unique(buckets, return_counts=True)
        self.ids.frombytes(ids.astype(np.int32).tobytes())
        self.shares.frombytes((count / max(1, len(buckets))).astype(np.float32).tobytes())
        self.ends.append(len(self.ids))

    def done(self) -> Bags:
        self.ids, self.shares = np.frombuffer(self.ids, np.int32), np.frombuffer(self.shares, np.float32)
        return self

    def __len__(self) -> int:
        return len(self.ends) - 1

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.ends[i], self.ends[i + 1])
        return self.ids[at], self.shares[at]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))

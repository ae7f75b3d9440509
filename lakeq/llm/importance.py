"""Importance resampling of documents towards a target text set.

Hashed n-gram features: every run of 1 to ``n`` words falls into one of ``buckets``
buckets. A bucket's gain is the logarithm of how much likelier it is in the target
than in the documents; a document's weight is the sum of the gains of its features,
and the documents with the highest weight plus Gumbel noise of their id are drawn.

N-grams are interned per batch in an open-addressed table of numpy arrays: the key is
the xxhash64 of the n-gram's bytes, slots are probed one after the other for all
occurrences at once, and a slot counts as an occurrence's own only when length and
bytes agree. A slot stores its bucket (so crc32 runs once per distinct n-gram) and its
count. The counting pass adds slot counts by bucket; the scoring pass gathers the
gains through the slot number of each occurrence.

What moves between tasks: ``buckets`` sums a task, then thin rows (id and numbers).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeq.llm import textvec
from lakeq.llm.common import Scratch, text_batches

_U = np.uint64

# Word bytes after lower-casing: digits, a-z and all bytes of other alphabets.
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

# Fixed values of the public xxHash64 specification.
P1, P2, P3, P4, P5 = (_U(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161,
                                      9650029242287828579, 2870177450012600261))
LONG = 32  # from this length on, xxHash64 works on stripes: left to the xxhash package


def joined_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows' words, lower-cased, one space after each: (bytes, start of each word, its
    end, its row)."""
    low = textvec.lower(data)
    inside = WORD[low]
    start, end = textvec.spans(inside, offs)
    length = end - start
    to = np.cumsum(length + 1)
    out = np.full(int(to[-1]) if len(to) else 0, 0x20, np.uint8)
    place = np.flatnonzero(inside)
    out[np.arange(len(place)) + np.repeat(np.arange(len(start)), length)] = low[place]
    return out, to - length - 1, to - 1, textvec.row_of(offs, start)


def word_runs(start: np.ndarray, end: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans and rows of all runs of 1 to n words of one row."""
    spans = [(start, end, row)]
    for k in range(2, n + 1):
        same = np.flatnonzero(row[:-k + 1] == row[k - 1:])
        spans.append((start[same], end[same + k - 1], row[same]))
    return tuple(np.concatenate(x) for x in zip(*spans))


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as a little-endian number (zeros beyond the end)."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray((len(data) + 1,), "<u8", padded.tobytes(), strides=(1,)).copy()


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << _U(r)) | (x >> _U(64 - r))


def xxh64(data: np.ndarray, eights: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """xxHash64 (seed 0) of the bytes in each [start, end)."""
    length = end - start
    h = P5 + length.astype(np.uint64)
    at, left = start.copy(), length.copy()
    while True:
        i = np.flatnonzero((left >= 8) & (length < LONG))
        if not len(i):
            break
        h[i] = _rotl(h[i] ^ (_rotl(eights[at[i]] * P2, 31) * P1), 27) * P1 + P4
        at[i] += 8
        left[i] -= 8
    i = np.flatnonzero((left >= 4) & (length < LONG))
    h[i] = _rotl(h[i] ^ ((eights[at[i]] & _U(0xFFFFFFFF)) * P1), 23) * P2 + P3
    at[i] += 4
    left[i] -= 4
    while True:
        i = np.flatnonzero((left >= 1) & (length < LONG))
        if not len(i):
            break
        h[i] = _rotl(h[i] ^ (data[at[i]].astype(np.uint64) * P5), 11) * P1
        at[i] += 1
        left[i] -= 1
    h = (h ^ (h >> _U(33))) * P2
    h = (h ^ (h >> _U(29))) * P3
    h ^= h >> _U(32)
    for i in np.flatnonzero(length >= LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(data[start[i]:end[i]].tobytes())
    return h


def _same_bytes(eights: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Do the spans of equal length from ``a`` and from ``b`` hold the same bytes?"""
    same = np.ones(len(a), bool)
    left, step = length.copy(), 0
    open_ = np.arange(len(a))
    while len(open_):
        unused = _U(8) * (_U(8) - np.minimum(left[open_], 8).astype(np.uint64))
        x, y = eights[a[open_] + step] << unused, eights[b[open_] + step] << unused
        same[open_] = x == y
        left[open_] -= 8
        step += 8
        open_ = open_[same[open_] & (left[open_] > 0)]
    return same


class Interned:
    """The distinct n-grams of some spans: ``slot`` of each occurrence in arrays
    ``owner`` (an occurrence that has the slot's bytes, -1: free), ``count`` and ``bucket``."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, buckets: int,
                 hashes: np.ndarray | None = None):
        eights = _eights(data)
        length = end - start
        h = xxh64(data, eights, start, end) if hashes is None else hashes
        size = 1 << max(4, (2 * len(h)).bit_length())
        self.owner = np.full(size, -1, np.int64)
        self.slot = (h & _U(size - 1)).astype(np.int64)
        pending = np.arange(len(h))
        while len(pending):
            at = self.slot[pending]
            free = self.owner[at] < 0
            self.owner[at[free]] = pending[free]  # of several claims on a free slot one stays
            own = self.owner[at]
            match = (h[own] == h[pending]) & (length[own] == length[pending])
            i = np.flatnonzero(match)
            match[i] = _same_bytes(eights, start[own[i]], start[pending[i]], length[pending[i]])
            pending = pending[~match]
            self.slot[pending] = (self.slot[pending] + 1) & (size - 1)
        self.count = np.bincount(self.slot, minlength=size)
        self.bucket = np.zeros(size, np.int64)
        used = np.flatnonzero(self.owner >= 0)
        first = self.owner[used]
        text = data.tobytes()
        self.bucket[used] = [zlib.crc32(text[i:j]) % buckets for i, j in zip(start[first].tolist(), end[first].tolist())]


def bucket_counts(texts: DataFrame, text_col: str, n: int, buckets: int) -> np.ndarray:
    """Features of all texts in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, data, offs in textvec.slices(b.column(0)):
                words, start, end, row = joined_words(data, offs)
                start, end, _ = word_runs(start, end, row, n)
                if len(start):
                    interned = Interned(words, start, end, buckets)
                    np.add.at(total, interned.bucket, interned.count)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in (texts.select(F.col(text_col).cast("string")).mapInArrow(run, "bucket int, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")).collect()):  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket, floor(1000 * ln(smoothed share in the target / in the documents))."""
    total, wanted, k = float(documents.sum()), float(target.sum()), len(documents)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (total + k) / ((s + 1.0) * (wanted + k))))
                     for s, t in zip(documents.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, n: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for b in batches:
            n_words, n_features, weight = ([np.zeros(0, np.int64)] for _ in range(3))
            for at, last, data, offs in textvec.slices(b.column(1)):
                words, start, end, row = joined_words(data, offs)
                n_words.append(np.bincount(row, minlength=last - at))
                start, end, row = word_runs(start, end, row, n)
                n_features.append(np.bincount(row, minlength=last - at))
                sums = np.zeros(last - at, np.int64)
                if len(start):
                    interned = Interned(words, start, end, len(gain))
                    np.add.at(sums, row, gain[interned.bucket][interned.slot])
                weight.append(sums)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(np.concatenate(x).astype(np.int64)) for x in (n_words, n_features, weight))],
                names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(
        run, f"doc_id {id_type}, n_words long, n_features long, weight long")


def numbered(rows: DataFrame, scratch: Scratch, *order) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, ...) in ``order``, by one range shuffle: each task
    numbers its sorted range, and the ranges' sizes give the offsets."""
    fields = rows.schema
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for b in batches:
            nth = pa.array(np.arange(seen + 1, seen + 1 + b.num_rows, dtype=np.int64))
            seen += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, nth], names=[*b.schema.names, "nth"])

    parts = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
             .withColumn("part", F.spark_partition_id()))
    parts = scratch.table(parts.mapInArrow(run, f"{types}, part int, nth long"), "ranges")
    # One row a range: as many as a shuffle has partitions.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    size = parts.groupBy("part").agg(F.count("*").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return parts.join(F.broadcast(size.select("part", "before")), "part").select(
        *(f"`{f.name}`" for f in fields), (F.col("nth") + F.col("before")).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, percent: int = 10,
             min_words: int = 20, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document row; ``rank`` is
    1, 2, ... for the drawn ones, else null.

    Words are runs of ASCII letters (A-Z lower-cased), digits and characters beyond
    ASCII. Of the N documents of ``min_words`` words or more, floor(percent * N / 100)
    are drawn, by score, ties to the smaller id.

    Edge cases: null texts and texts without words have no features and weight 0; a
    null id counts as empty text in the noise and comes before all others among
    ties; repeated rows are documents of their own, ranked next to each other; other
    columns are not read; empty tables give gains from smoothing alone.
    """
    spark = docs.sparkSession
    text_batches(spark)
    scratch = Scratch(spark, "importance")
    gain = gains(bucket_counts(docs, text_col, n, buckets), bucket_counts(target, target_col, n, buckets))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = scratch.table(weigh(docs, gain, n, id_col, text_col).withColumn(
        "score", F.col("weight") + noise.cast("long")), "scored")
    eligible = scored.where(F.col("n_words") >= min_words)
    draw = percent * eligible.count() // 100
    ranked = numbered(eligible, scratch, F.desc("score"), F.asc_nulls_first("doc_id"))
    rank = F.when(F.col("rank") <= draw, F.col("rank"))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", rank).unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


def drawn_documents(docs: DataFrame, ranked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id was drawn."""
    ids = ranked.where("rank is not null").select(F.col("doc_id").alias("__drawn_id")).distinct()
    return docs.join(ids, docs[id_col].eqNullSafe(F.col("__drawn_id")), "left_semi")

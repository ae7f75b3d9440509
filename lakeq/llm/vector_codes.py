"""Vector code compression: integer product codes found by slice and intersect.

Vectors become integers floor(scale * x) and are cut into equal consecutive parts;
each part position has its own codebook, refined by rounds of assigning every part
to its nearest entry and moving entries to the floor of their parts' mean.

The nearest entry is found exactly without comparing all of them. Per dimension the
entries' coordinates are sorted, and prefix masks say which entries come before each
place (bit i of multiword uint64 masks is entry i). The least distance to a few
entries, the nearest in each of the dimensions that spread most, is the initial
radius: no entry as near can differ by more in any dimension. So per dimension two binary searches give a
range of the sorted coordinates, its mask is the difference of two prefix masks, and
the masks of all dimensions ANDed leave the candidates, which hold the nearest entry
and all its ties. Only candidates get a distance.

Spark holds the vectors; a round sends the codebooks (parts x entries vectors) to the
tasks, which return sums per part and entry, so each round moves a bounded number of
numbers whatever the size of the table or of one entry's share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeq.llm.common import Scratch

STARTS = 4  # dimensions that give an entry for the initial radius

_U = np.uint64


class Codebooks(NamedTuple):
    scale: int
    entries: np.ndarray  # (parts, entries, dimensions of a part), int64

    def sha256(self) -> str:
        """Hash of all components by part, entry and position, as decimal text."""
        text = ",".join(map(str, self.entries.reshape(-1).tolist()))
        return hashlib.sha256(text.encode()).hexdigest()


class Slices:
    """Nearest of some integer points, by prefix masks over sorted coordinates."""

    def __init__(self, points: np.ndarray):
        self.points = points
        n, dims = points.shape
        self.words = -(-n // 64)
        order = np.argsort(points, axis=0, kind="stable")
        self.order = order
        self.sorted = [np.ascontiguousarray(points[order[:, d], d]) for d in range(dims)]
        self.masks = np.zeros((dims, n + 1, self.words), np.uint64)
        for d in range(dims):
            for i, entry in enumerate(order[:, d].tolist()):
                self.masks[d, i + 1] = self.masks[d, i]
                self.masks[d, i + 1, entry // 64] |= _U(1) << _U(entry % 64)
        self.widest = np.argsort(points.min(axis=0) - points.max(axis=0), kind="stable")[:STARTS].tolist()

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """(rows, words) masks of the entries within the initial radius in every dimension."""
        bound = np.full(len(x), np.iinfo(np.int64).max)
        for d in self.widest:
            near = self.sorted[d]
            at = np.searchsorted(near, x[:, d])
            left, right = np.maximum(at - 1, 0), np.minimum(at, len(near) - 1)
            at = np.where(x[:, d] - near[left] <= near[right] - x[:, d], left, right)
            bound = np.minimum(bound, ((x - self.points[self.order[at, d]]) ** 2).sum(axis=1))
        # One more than the root: a float root may be short of the integer one.
        radius = np.sqrt(bound.astype(np.float64)).astype(np.int64) + 1
        out = np.full((len(x), self.words), ~_U(0))
        for d, coordinates in enumerate(self.sorted):
            low = np.searchsorted(coordinates, x[:, d] - radius, "left")
            high = np.searchsorted(coordinates, x[:, d] + radius, "right")
            out &= self.masks[d, high] ^ self.masks[d, low]
        return out

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest point (ties to the lower) and the squared distance."""
        if not len(x):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        bits = np.unpackbits(self.candidates(x).view(np.uint8), axis=1, bitorder="little")
        row, entry = np.nonzero(bits[:, :len(self.points)])
        distance = ((x[row] - self.points[entry]) ** 2).sum(axis=1)
        first = np.searchsorted(row, np.arange(len(x)))
        least = np.minimum.reduceat(distance, first)
        hit = np.flatnonzero(distance == least[row])
        hit = hit[np.searchsorted(row[hit], np.arange(len(x)))]
        return entry[hit], least


def _parts(vectors: pa.Array, parts: int) -> np.ndarray:
    """(parts, rows, dimensions of a part) of integer vectors of one length."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy().reshape(len(vectors), -1)
    return np.ascontiguousarray(flat.reshape(len(vectors), parts, -1).transpose(1, 0, 2))


def whole_vectors(vector: Column) -> Column:
    """Not null, and without null or non-finite components."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def integer_vectors(vectors: DataFrame, scratch: Scratch, parts: int, scale: int,
                    id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, written once: ``v`` holds
    floor(scale * x) as long."""
    v = F.col(vector_col)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), v.alias("x")).where(
        whole_vectors(F.col("x")) & (F.size("x") > 0))
    lengths = rows.groupBy(F.size("x").alias("n")).agg(
        F.count("*").alias("rows"), F.max(F.array_max(F.transform("x", lambda c: F.abs(c.cast("double"))))).alias("most"))
    found = sorted(lengths.limit(3).collect(), key=lambda r: -r["rows"])
    if not found:
        return scratch.table(rows.select("vec_id", "label", F.array(F.lit(0).cast("long")).alias("v")).limit(0), "integers")
    if len(found) > 1:
        raise ValueError(f"vectors of different lengths, {found[0]['n']} and {found[1]['n']} among them")
    n = found[0]["n"]
    if n % parts:
        raise ValueError(f"vectors of {n} components can't be cut into {parts} equal parts")
    # A difference of two components, squared and summed over a vector, must fit a long.
    limit = int((2.0**61 / n) ** 0.5)
    if found[0]["most"] * scale > limit - 2:
        raise ValueError(f"components beyond {limit / scale:.6g}: distances would not fit a 64-bit integer")
    return scratch.table(rows.select("vec_id", "label", F.transform(
        "x", lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v")), "integers")


def _round(integers: DataFrame, books: Codebooks) -> Codebooks:
    """Entries moved to the floor of the mean of the parts assigned to them."""
    parts, size, dims = books.entries.shape
    sent = integers.sparkSession.sparkContext.broadcast(books.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(e) for e in sent.value]
        sums = np.zeros((parts, size, dims), np.int64)
        count = np.zeros((parts, size), np.int64)
        for b in batches:
            for p, x in enumerate(_parts(b.column(0), parts)):
                entry, _ = slices[p].nearest(x)
                np.add.at(sums[p], entry, x)
                count[p] += np.bincount(entry, minlength=size)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(count[p, e]),
             pa.array(sums[p, e].tolist(), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    # Sums of one task fit a long (2**31 rows or more of the largest component); decimals add the tasks.
    total = (integers.select("v").mapInArrow(run, "part int, entry int, n long, sums array<long>")
             .select("part", "entry", "n", F.posexplode("sums").alias("position", "value"))
             .groupBy("part", "entry", "position")
             .agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("total")).collect())
    entries = books.entries.copy()
    for r in total:  # parts x entries x dimensions rows at most
        entries[r["part"], r["entry"], r["position"]] = int(r["total"]) // r["n"]
    return books._replace(entries=entries)


def fit(integers: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> Codebooks | None:
    """Codebooks of a table (vec_id, v) of integer vectors (None of an empty one):
    the ``entries`` smallest ids (nulls last, equal ids by vector), then ``rounds``
    rounds over all rows."""
    first = integers.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return None
    start = np.array([r["v"] for r in first], np.int64)
    books = Codebooks(scale, np.ascontiguousarray(start.reshape(len(first), parts, -1).transpose(1, 0, 2)))
    for _ in range(rounds):
        books = _round(integers, books)
    return books


def encode(integers: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error): two hex digits for each part, and the squared
    distances to the entries summed over the parts."""
    parts = len(books.entries)
    sent = integers.sparkSession.sparkContext.broadcast(books.entries)
    types = {f.name: f.dataType.simpleString() for f in integers.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(e) for e in sent.value]
        for b in batches:
            code = np.zeros((b.num_rows, parts), np.uint8)
            error = np.zeros(b.num_rows, np.int64)
            for p, x in enumerate(_parts(b.column(2), parts)):
                entry, distance = slices[p].nearest(x)
                code[:, p] = entry
                error += distance
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(error)],
                names=["vec_id", "label", "code", "error"])

    return integers.select("vec_id", "label", "v").mapInArrow(
        run, f"vec_id {types['vec_id']}, label {types['label']}, code string, error long")


def decode(code: str, books: Codebooks) -> list[float]:
    """The vector that a code stands for: the middle of each component's step."""
    index = bytes.fromhex(code)
    return [(c + 0.5) / books.scale for p, i in enumerate(index) for c in books.entries[p, i].tolist()]


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector that takes
    part; ``label_error`` sums the errors of equal labels, null labels together.

    Edge cases: null and empty vectors and vectors with null or non-finite components
    are left out; repeated ids and rows are vectors of their own; a null id comes
    after all others; with fewer vectors than ``entries`` the codebooks are shorter;
    ties go to the lower entry; other columns are not read; an empty table gives an
    empty result. Vectors of different lengths, a length that the parts don't
    divide, and components so large that a distance exceeds a long raise ValueError.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    scratch = Scratch(vectors.sparkSession, "vector-codes")
    integers = integer_vectors(vectors, scratch, parts, scale, id_col, vector_col, label_col)
    books = fit(integers, parts, entries, rounds, scale)
    if books is None:
        return integers.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                               F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = scratch.table(encode(integers, books), "coded")
    # Labels as one non-null key, summed before the shuffle; the join splits hot labels.
    key = F.to_json(F.struct("label"))
    by_label = coded.groupBy(key.alias("key")).agg(F.sum("error").alias("label_error"))
    scratch.finish(coded)
    return coded.withColumn("key", key).join(by_label, "key").select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))

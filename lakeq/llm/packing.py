"""Best-fit packing into sequences of several permitted lengths.

Documents are cut into pieces of at most the largest length; the rest of each is
packed best-fit decreasing. What matters to best-fit is how many pieces there
are of each length, and a length is at most the largest capacity, so the plan is
made from a histogram of bounded size: whole classes of equal bins are filled at
a time, which gives the same bins as placing pieces one by one. A new bin is
opened in the size with the least cost per word it can be expected to hold, and
at the end every bin is downsized to the smallest permitted length that holds
its contents.

The pieces then look up their bins: a piece's number among those of its length
comes from a salted row number plus salt offsets (no length, however common, is
one task), and the bounded plan is sent to every task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeq.llm import textvec
from lakeq.llm.common import Scratch, parallelism, text_batches


def sequence_cost(capacity: int) -> float:
    """Relative cost of one training sequence: linear work, attention, a fixed part."""
    return capacity * (1 + capacity / 16384) + 16


@dataclass
class Bins:
    """A class of equal bins: how many, the room left, and pieces by length."""
    count: int
    room: int
    held: tuple[tuple[int, int], ...]

    def add(self, count: int, length: int, n: int) -> Bins:
        return Bins(count, self.room - length * n, (*self.held, (length, n)))


def plan(histogram: Mapping[int, int], capacities: Sequence[int],
         cost: Callable[[int], float] = sequence_cost) -> list[tuple[int, Bins]]:
    """Variable-capacity best-fit decreasing on piece counts by length.

    Returns (capacity after downsizing, class of bins). Longer pieces go first;
    each goes into the open bin with the least room that holds it, else into a
    new bin of the capacity with the least cost per word held, counting what
    equal and shorter pieces can still fill.
    """
    sizes = sorted(capacities)
    open_by_room: dict[int, list[Bins]] = {}
    rooms = np.zeros(sizes[-1] + 1, bool)
    closed: list[Bins] = []
    shorter = sum(length * n for length, n in histogram.items())

    def put(b: Bins) -> None:
        if b.count and b.room:
            open_by_room.setdefault(b.room, []).append(b)
            rooms[b.room] = True
        elif b.count:
            closed.append(b)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        shorter -= length * left
        while left:
            fitting = np.flatnonzero(rooms[length:])
            if len(fitting):
                room = int(fitting[0]) + length
                bins = open_by_room[room].pop()
                if not open_by_room[room]:
                    rooms[room] = False
            else:
                def per_word(c: int) -> float:
                    n = min(c // length, left)
                    return cost(c) / (length * n + min(c - length * n, shorter))
                c = min((c for c in sizes if c >= length), key=lambda c: (per_word(c), c))
                bins = Bins(max(1, left // (c // length)), c, ())
            each = bins.room // length
            full = min(bins.count, left // each)
            put(bins.add(full, length, each))
            left -= full * each
            rest = bins.count - full
            if rest and left and left < each:
                put(bins.add(1, length, left))
                rest, left = rest - 1, 0
            put(Bins(rest, bins.room, bins.held))
    out = []
    for b in [*closed, *(b for group in open_by_room.values() for b in group)]:
        words = sum(length * n for length, n in b.held)
        out.append((next(c for c in sizes if c >= words), b))
    return sorted(out, key=lambda x: (-x[0], x[1].room, x[1].held))


def _lookup(planned: list[tuple[int, Bins]]) -> dict[str, np.ndarray]:
    """The plan by (length, first piece number): where runs of pieces go."""
    used: dict[int, int] = {}
    rows, first_bin = [], 0
    for capacity, b in planned:
        at, words = 0, sum(length * n for length, n in b.held)
        for length, n in b.held:
            start = used.get(length, 0)
            rows.append((length, start, n, first_bin, at, capacity, words))
            used[length] = start + n * b.count
            at += length * n
        first_bin += b.count
    rows.sort()
    names = ("length", "start", "each", "bin", "at", "capacity", "words")
    return {k: np.array([r[i] for r in rows], np.int64) for i, k in enumerate(names)}


def pieces(docs: DataFrame, largest: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start_word, n_words) of every document; one row with no
    words for a document without any."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(textvec.word_counts(b.column(1)))],
                                             names=["doc_id", "words"])

    counted = docs.select(id_col, text_col).mapInArrow(count, f"doc_id {id_type}, words long")
    last = F.greatest(F.ceil(F.col("words") / largest) - 1, F.lit(0))
    return (counted.select("doc_id", "words", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
            .select("doc_id", F.col("piece").cast("int").alias("piece"),
                    (F.col("piece") * largest).alias("start_word"),
                    F.least(F.lit(largest), F.col("words") - F.col("piece") * largest).alias("n_words")))


def pack(docs: DataFrame, capacities: Sequence[int] = (512, 1024, 2048, 4096),
         cost: Callable[[int], float] = sequence_cost, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return one row per piece: doc_id, piece, start_word, n_words, bin_id, bin_at
    (words before it in its bin), bin_words and bin_capacity.

    Edge cases: a document without words (null, empty, only white space) has one
    row without a bin; a text longer than the largest capacity becomes several
    pieces that cover all of it; rows that repeat an id are packed as often as
    they stand there; ties between pieces of one length go by doc_id and piece;
    other columns are not read; an empty table gives an empty result.
    """
    spark, largest = docs.sparkSession, max(capacities)
    text_batches(spark)
    scratch = Scratch(spark, "pack")
    items = scratch.table(pieces(docs, largest, id_col, text_col), "pieces")
    # At most `largest` rows: lengths are bounded by the capacity.
    histogram = {r["n_words"]: r["n"] for r in items.where("n_words > 0").groupBy("n_words")
                 .agg(F.count("*").alias("n")).collect()}
    table = _lookup(plan(histogram, capacities, cost))
    salts = max(64, parallelism(spark))
    salted = items.where("n_words > 0").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    offsets = salted.groupBy("n_words", "salt").agg(F.count("*").alias("n")).select(
        "n_words", "salt",
        (F.sum("n").over(W.partitionBy("n_words").orderBy("salt")) - F.col("n")).alias("salt_start"))
    numbered = (salted.withColumn("i", F.row_number().over(W.partitionBy("n_words", "salt").orderBy("doc_id", "piece")) - 1)
                .join(offsets, ["n_words", "salt"])
                .select("doc_id", "piece", "start_word", "n_words", (F.col("i") + F.col("salt_start")).alias("i")))
    sent = spark.sparkContext.broadcast(table)  # bounded by the capacities

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = sent.value
        key = t["length"] * (1 << 44) + t["start"]
        for b in batches:
            length, i = (b[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n_words", "i"))
            r = np.searchsorted(key, length * (1 << 44) + i, "right") - 1
            k = i - t["start"][r]
            out = [t["bin"][r] + k // t["each"][r], t["at"][r] + k % t["each"][r] * length, t["words"][r]]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], *map(pa.array, out), pa.array(t["capacity"][r].astype(np.int32))],
                names=["doc_id", "piece", "start_word", "n_words", "bin_id", "bin_at", "bin_words", "bin_capacity"])

    id_type = items.schema["doc_id"].dataType.simpleString()
    placed = numbered.mapInArrow(place, f"doc_id {id_type}, piece int, start_word long, n_words long, bin_id long, "
                                        "bin_at long, bin_words long, bin_capacity int")
    none = items.where("n_words = 0").select("*", *[F.lit(None).cast(t).alias(c) for c, t in (
        ("bin_id", "long"), ("bin_at", "long"), ("bin_words", "long"), ("bin_capacity", "int"))])
    return placed.unionByName(none)

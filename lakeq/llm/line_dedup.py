"""Line dedup: a suffix array over line-ID sequences by distributed prefix doubling.

Every document is a sequence of line ids. Suffixes are ranked by their first
1, 2, 4, ... lines: the next rank of a suffix is the order of its pair (own rank,
rank of the suffix 2**k lines on). A suffix whose prefix is unique, or that is
shorter, has no longer repeat and leaves, so each round handles repeats only.

Suffixes with a common prefix form an LCP interval. A run of lines is a later
copy if an interval holds an earlier suffix with the same run, and it is deleted
if it has at least ``min_words`` words. For every suffix the shortest prefix with
that many words is looked up by two overlapping ranks. Consecutive starts whose
prefix has an earlier copy belong to one maximal repeat, and where the last of
them ends follows from its longest common prefix with any earlier suffix, found
by descending the doubling levels through its interval. "Earlier" is by doc_id,
then position; the first copy always stays.

Each round is a window by document, a map-side combined aggregate, a range sort
of distinct repeated pairs and a join that AQE can split, all written to the
shared scratch folder. Only ids and numbers move; the text is read twice, to cut
lines and to take out the deleted ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeq.llm import textvec
from lakeq.llm.common import THIN_ROWS, Scratch, at_most, free_names, text_batches

MIN_WORDS = 50


def _sequence_id(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _spot() -> Column:
    return F.struct("doc_id", "seq", "pos")


def cut_lines(data: np.ndarray, offs: np.ndarray, min_words: int) -> dict[str, np.ndarray]:
    """The lines of a slice of texts: row, pos, line (hash), left (lines to the end
    of the text), need (lines until there are min_words words; 0: never), room
    (lines a repeat can go on after these without counting from the next line)."""
    newline = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate((offs[:-1], newline + 1)))
    end = np.sort(np.concatenate((newline, offs[1:])))
    per = np.bincount(textvec.row_of(offs, newline), minlength=len(offs) - 1) + 1
    first = np.concatenate(([0], np.cumsum(per)))
    row = np.repeat(np.arange(len(per)), per)
    number = np.arange(len(start))
    last = first[1:][row]
    word, _ = textvec.words(data, offs)
    before = np.concatenate((np.searchsorted(word, start), [len(word)]))
    reach = np.searchsorted(before, before[:-1] + min_words, "left")
    need = np.where(reach <= last, reach - number, 0)
    left = last - number
    after = np.append(need[1:], 0)
    after = np.where((left > 1) & (after > 0), after, left)
    return {"row": row, "pos": number - first[:-1][row],
            "line": textvec.span_hash(textvec.rolling(data), start, end).view(np.int64),
            "left": left, "need": need, "room": np.where(need > 0, np.maximum(after - need, 0), 0)}


def lines(docs: DataFrame, min_words: int) -> DataFrame:
    """One row per line of (doc_id, seq, text)."""
    names = ("pos", "line", "left", "need", "room")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, end, data, offs in textvec.slices(b.column(2)):
                cut = cut_lines(data, offs, min_words)
                row = pa.array(cut["row"] + at)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(row), b.column(1).take(row),
                     *(pa.array(cut[c].astype(np.int64 if c == "line" else np.int32)) for c in names)],
                    names=["doc_id", "seq", *names])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {id_type}, seq long, pos int, line long, left int, need int, room int")


def _ranked(pairs: DataFrame, keys: list[str], scratch: Scratch, level: int) -> DataFrame:
    """(keys, rank) of the keys that repeat; ranks rise in the order of the keys."""
    repeated = pairs.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    # Ids that rise over the partitions of a global sort are ranks with gaps.
    return scratch.table(repeated.orderBy(*keys).select(*keys, F.monotonically_increasing_id().alias("rank")),
                         f"order{level}")


def doubling(cut: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """For k = 0, 1, ...: (doc_id, seq, pos, rank) of the suffixes whose first 2**k
    lines also start another suffix, ranked by these lines."""
    order = _ranked(cut, ["line"], scratch, 0)
    levels = [scratch.table(cut.join(order, "line").select("doc_id", "seq", "pos", "rank"), "level0")]
    while True:
        k = len(levels) - 1
        ahead = W.partitionBy("doc_id", "seq").orderBy("pos").rangeBetween(2**k, 2**k)
        pairs = scratch.table(levels[k].select("doc_id", "seq", "pos", F.col("rank").alias("one"),
                                               F.max("rank").over(ahead).alias("two")).where("two is not null"),
                              f"pairs{k + 1}")
        order = _ranked(pairs, ["one", "two"], scratch, k + 1)
        if order.isEmpty():
            return levels
        levels.append(scratch.table(pairs.join(order, ["one", "two"]).select("doc_id", "seq", "pos", "rank"),
                                    f"level{k + 1}"))
        scratch.drop(pairs, order)


def _shifted(level: DataFrame, name: str) -> DataFrame:
    return level.select("doc_id", "seq", F.col("pos").alias("at"), F.col("rank").alias(name))


def copied_starts(cut: DataFrame, levels: list[DataFrame], scratch: Scratch) -> DataFrame:
    """(node, doc_id, seq, pos, reach, room, later): every suffix whose first
    ``need`` lines start another one, its group, and whether it is not the first."""
    tables = [level.withColumn("k", F.lit(k)) for k, level in enumerate(levels)]
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    wanted = cut.where("need > 0").withColumn("k", F.floor(F.log2(F.col("need").cast("double"))).cast("int"))
    one = wanted.join(every.withColumnRenamed("rank", "one"), ["doc_id", "seq", "pos", "k"])
    two = every.select("doc_id", "seq", F.col("pos").alias("at"), "k", F.col("rank").alias("two"))
    both = scratch.table(
        one.withColumn("at", F.col("pos") + F.col("need") - F.pow(F.lit(2), F.col("k")).cast("int"))
        .join(two, ["doc_id", "seq", "at", "k"]).select("doc_id", "seq", "pos", "need", "room", "one", "two"), "starts")
    first = scratch.table(both.groupBy("need", "one", "two").agg(F.min(_spot()).alias("first"), F.count("*").alias("n"))
                          .where("n > 1").select("need", "one", "two", "first"), "first")
    return scratch.table(
        both.join(first, ["need", "one", "two"]).select(
            F.xxhash64("need", "one", "two").alias("node"), "doc_id", "seq", "pos", F.col("need").alias("reach"), "room",
            (_spot() != F.col("first")).alias("later")), "copied")


def longest(members: DataFrame, seekers: DataFrame, levels: list[DataFrame], scratch: Scratch) -> DataFrame:
    """(doc_id, seq, pos, reach) of ``seekers``, with ``reach`` raised to the longest
    prefix that they share with any earlier suffix.

    ``members`` are all suffixes of the seekers' groups. At step 2**k each group
    splits by the rank of what follows; a seeker goes on with those that share it
    if one of them is earlier, else it stays with the whole group.
    """
    room = seekers.agg(F.max("room")).first()[0] or 0
    for k in range(min(len(levels) - 1, int(room).bit_length() - 1), -1, -1):
        next_ = scratch.table(members.withColumn("at", F.col("pos") + F.col("reach"))
                              .join(_shifted(levels[k], "next"), ["doc_id", "seq", "at"]).drop("at"), f"next{k}")
        first = scratch.table(next_.groupBy("node", "next").agg(F.min(_spot()).alias("first")), f"least{k}")
        goes = (seekers.join(next_.select("node", "doc_id", "seq", "pos", "next"), ["node", "doc_id", "seq", "pos"])
                .join(first, ["node", "next"]).where(F.col("first") < _spot())
                .select("node", "doc_id", "seq", "pos", "next"))
        seekers = scratch.table(
            seekers.join(goes, ["node", "doc_id", "seq", "pos"], "left").select(
                F.when(F.col("next").isNull(), F.col("node")).otherwise(F.xxhash64("node", "next", F.lit(k))).alias("node"),
                "doc_id", "seq", "pos",
                (F.col("reach") + F.when(F.col("next").isNull(), 0).otherwise(2**k)).alias("reach"),
                F.col("node").alias("from"), "next"), f"seekers{k}")
        splits = seekers.where("next is not null").select(F.col("from").alias("node"), "next").distinct()
        stays = seekers.where("next is null").select(F.col("from").alias("node")).distinct()
        members = scratch.table(
            next_.join(splits, ["node", "next"]).select(F.xxhash64("node", "next", F.lit(k)).alias("node"), "doc_id", "seq",
                                                        "pos", (F.col("reach") + 2**k).alias("reach"))
            .unionByName(members.select("node", "doc_id", "seq", "pos", "reach").join(stays, "node")), f"members{k}")
        seekers = seekers.drop("from", "next")
    return seekers.select("doc_id", "seq", "pos", "reach")


def copied_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, seq, from_line, to_line) of the maximal later copies; ``seq`` tells
    rows with one id but different texts apart."""
    text_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "lines")
    # Within a struct, because null ids are equal there: joins would lose them.
    texts = docs.where(F.col(text_col).isNotNull()).select(
        F.struct(F.col(id_col).alias("id")).alias("doc_id"), _sequence_id(id_col, text_col).alias("seq"),
        F.col(text_col).alias("text"))
    cut = scratch.table(lines(texts, min_words).distinct(), "lines")  # repeated rows are one document
    levels = doubling(cut, scratch)
    members = copied_starts(cut, levels, scratch)
    # Neighbouring starts with an earlier copy are one run; its end is that of its last start.
    by_doc = W.partitionBy("doc_id", "seq").orderBy("pos")
    later = (members.where("later").withColumn("run", F.col("pos") - F.row_number().over(by_doc))
             .withColumn("ends", F.coalesce(F.lead("pos").over(by_doc) != F.col("pos") + 1, F.lit(True)))
             .withColumn("from_line", F.min("pos").over(W.partitionBy("doc_id", "seq", "run"))))
    ends = scratch.table(later.where("ends").drop("later", "run", "ends"), "ends")
    seekers = ends.where("room > 0").drop("from_line")
    groups = members.join(seekers.select("node").distinct(), "node").drop("room", "later")
    reached = longest(groups, seekers, levels, scratch).withColumnRenamed("reach", "further")
    runs = scratch.table(
        ends.join(reached, ["doc_id", "seq", "pos"], "left").select(
            F.col("doc_id.id").alias("doc_id"), "seq", "from_line",
            (F.col("pos") + F.coalesce("further", "reach")).alias("to_line")), "runs")
    scratch.finish(runs)
    return runs


def drop_copied_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                      text_col: str = "text", counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """``docs`` without the lines of later copies, plus the numbers of lines before
    and of removed lines, named by ``counts``; columns of these names are replaced.

    Lines are what newlines separate, compared byte by byte. Edge cases: a null
    text stays null with 0 lines; an empty text is one empty line; a text of
    which nothing stays becomes empty; runs may overlap themselves and lie in one
    document; rows that repeat both id and text count as one document and are all
    changed alike; texts with a null id come first and lose copied runs too; other columns pass
    through; an empty table stays empty.
    """
    runs = copied_runs(docs, min_words, id_col, text_col)
    doc, seq, found, own = free_names(docs, "run_doc", "run_seq", "runs", "own_seq")
    spans = runs.select(F.col("doc_id").alias(doc), F.col("seq").alias(seq), "from_line", "to_line").groupBy(
        doc, seq).agg(F.collect_list(F.struct("from_line", "to_line")).alias(found))  # at most a text's lines
    kept = [c for c in docs.columns if c not in counts]
    # Few documents lose lines: their runs are sent to every task while a count of runs
    # shows that they are few, and the texts stay where they are; else a merge join.
    side = F.broadcast(spans) if at_most(runs, THIN_ROWS) else spans.hint("merge")
    joined = (docs.select(*[f"`{c}`" for c in kept]).withColumn(own, _sequence_id(id_col, text_col))
              .join(side, F.col(id_col).eqNullSafe(F.col(doc)) & (F.col(own) == F.col(seq)), "left"))
    parts = F.split(F.col(text_col), "\n", -1)
    stay = F.filter(parts, lambda line, i: ~F.exists(found, lambda r: (i >= r["from_line"]) & (i < r["to_line"])))
    text = F.when(F.col(found).isNull(), F.col(text_col)).otherwise(F.array_join(stay, "\n"))
    n = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(parts))
    n_stay = F.when(F.col(found).isNull(), n).otherwise(F.size(stay))
    return joined.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in kept],
                         n.alias(counts[0]), (n - n_stay).alias(counts[1]))

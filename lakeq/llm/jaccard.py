"""N-gram Jaccard join with token-combination prefixes.

Tokens are hashed k-word shingles; a document is the set of its tokens. Tokens
are ordered rare first, then by hash. With ``t`` the threshold and ``n`` the set
size, two linked sets differ in at most ``d = n - ceil(t * n)`` tokens of either
one, so each set is indexed under signatures taken from a prefix of its order:

* rare tokens count singly, each is a signature;
* frequent tokens fall into subclasses, and each pair of prefix tokens of one
  subclass is a signature. Sharing no pair of a subclass means sharing at most
  one of its tokens, so a subclass with x prefix tokens shows x - 1 differences;
* the prefix is extended until it would show more than ``d`` differences.

Linked sets therefore share a signature. The number of subclasses goes with the
size range of a set (powers of two; a set whose partners can lie in the next
range is indexed under both), which keeps the pairs of a set below about a
third of its size and makes chance meetings of frequent tokens (a passage that
many documents share) rare.

Which tokens are frequent comes from counts over all documents: the
``MAX_FREQUENT`` tokens found in most sets, at least ``FREQUENT_FROM``. Any such
choice gives the same links, so its bounded size costs time only, never links.

Execution: the sets are recomputed from the text in each pass (cheaper than
storing them); hashes move in packed binary blocks, one per hash range. Equal
sets are one class from the start. Each map task pre-aggregates: of the sets
that share a signature only the first goes to the signature's range, the others
are written with it, so no signature gathers more entries than there are map
blocks. Candidate pairs are verified on the whole sets.

For components, each signature's sets are first compared with one of them. Sets that
share a signature but still lie in different components (near copies of one text that are not near enough to each other)
would make pairs with the square of their number, so these are joined by what tells
them apart. Sets that share several signatures form a cluster with one of them as its
centre c, and in clusters of more than ``GROUP`` each set X becomes its difference D(X)
from c (sets of smaller clusters, and sets far from their centre, are paired by their
signatures). As ``|X ^ Y| = |D(X) ^ D(Y)|``, with h the largest ``|X ^ Y|`` of a link:

* if ``|D(X)| + |D(Y)| <= h``, both are links of c itself, which is tested;
* otherwise a link shares ``o >= (|D(X)| + |D(Y)| - h) / 2 >= 1`` tokens of the
  differences. With the differences' tokens ordered rare first within the cluster, the
  larger difference needs a prefix of h + 1 tokens and the smaller one of h / 2 + 1 to
  share a token. What all copies have in common is in no difference, what is a copy's
  own comes first, so prefixes are short and mostly tokens that no other copy has.

Sets that share a prefix token are paired when they are at most ``GROUP``; larger
groups are compared tile by tile in tasks of bounded size, which return one link for
each set joined, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeq.llm import textvec
from lakeq.llm.common import THIN_ROWS, Scratch, at_most, free_names, parallelism, text_batches
from lakeq.llm.components import components

FREQUENT_FROM = 16
MAX_FREQUENT = 1 << 17       # tokens sent to every task: 1 MB
BLOCK = 2_000_000            # hashes that a task holds before it passes them on
RANGE = 1_000_000            # hashes of one hash range, about
FILTER_BITS = 26             # size of the filter of wanted sets: 8 MB
GROUP = 48                   # sets of a cluster, or of a difference token, that are still paired one by one
SHARED = 3                   # signatures that tell a near copy from a chance meeting
TILE = 256                   # sets of one side of a tile

_U = np.uint64


class Joined(NamedTuple):
    documents: DataFrame  # doc_id, text_key, n_shingles, set_key (null: empty), component_key, component_id
    links: DataFrame      # a, b (set keys), n_a, n_b, n_shared of the verified links


def token_sets(col: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per slice of rows: (first row, end row, distinct sorted tokens, row offsets)."""
    for at, end, data, offs in textvec.slices(col):
        h, to = textvec.shingles(data, offs, k)
        for r in range(end - at):
            h[to[r]:to[r + 1]].sort()
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        new[to[:-1][to[:-1] < len(h)]] = True
        yield at, end, h[new], np.concatenate(([0], np.cumsum(new)))[to]


def set_keys(tokens: np.ndarray, to: np.ndarray) -> np.ndarray:
    """64-bit hash of each row's token set."""
    sums = textvec.row_sums_u64(textvec.mix(tokens * textvec.MIX[58]), to)
    return textvec.mix(sums + np.diff(to).astype(np.uint64) * textvec.MIX[57]).view(np.int64)


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Tokens that a set of size n shares with any linked set, at least."""
    return -(-n * percent // 100)


def size_range(n: int) -> int:
    return int(n).bit_length() - 1


def ranges_of(n: int, percent: int) -> range:
    """Size ranges a set is indexed under: its own and that of larger partners."""
    return range(size_range(n), size_range(n * 100 // percent) + 1)


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of one set of sorted tokens; ``frequent`` marks tokens."""
    n = len(tokens)
    need = n - int(least_overlap(n, percent)) + 1
    rare = tokens[~frequent][:need]
    out = [textvec.mix(rare ^ textvec.MIX[56])]
    need -= len(rare)
    if need:
        common = tokens[frequent]
        for r in ranges_of(n, percent):
            classes = max(1, (1 << r) // 4)
            sub = (textvec.mix(common ^ textvec.MIX[55]) % _U(classes)).astype(np.int64)
            order = np.argsort(sub, kind="stable")
            grouped = sub[order]
            first = np.searchsorted(grouped, grouped, "left")
            nth = np.empty(len(common), np.int64)
            nth[order] = np.arange(len(common)) - first   # earlier prefix tokens of the subclass
            shown = np.cumsum(nth > 0)
            size = int(np.searchsorted(shown, need, "left")) + 1
            order = order[order < size]
            grouped, nth = sub[order], nth[order]
            value = common[order]
            for back in range(1, int(nth.max(initial=0)) + 1):
                at = np.flatnonzero(nth >= back)
                out.append(textvec.mix(value[at] * textvec.MIX[54] + value[at - back] * textvec.MIX[53] + _U(r + 1)))
    return np.concatenate(out)


def _blocks(values: np.ndarray, ranges: int) -> np.ndarray:
    """Boundaries of the hash ranges in sorted 64-bit values."""
    bits = ranges.bit_length() - 1
    edges = np.arange(1, ranges, dtype=np.uint64) << _U(64 - bits) if bits else np.zeros(0, np.uint64)
    return np.concatenate(([0], np.searchsorted(values, edges, "left"), [len(values)]))


def _rest(values: np.ndarray, ranges: int) -> bytes:
    """The 32 bits that follow the range number."""
    return (values >> _U(32 - (ranges.bit_length() - 1))).astype(np.uint32).tobytes()


def text_key(col: str) -> Column:
    """Tells rows that share an id but not their text apart."""
    return F.xxhash64(F.col(col))


class _Seen:
    """Sets a task has met, so that equal sets are handled once."""

    def __init__(self):
        self.keys: set[int] = set()

    def new(self, key: int) -> bool:
        if key in self.keys:
            return False
        self.keys.add(key)
        return True


def bitmap(tokens: np.ndarray) -> bytes:
    """Marks of tokens by their low bits, in the next power of two of their number."""
    size = max(64, 1 << (len(tokens) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(tokens & _U(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def may_link(x: bytes, y: bytes, n_x: int, n_y: int, percent: int) -> bool:
    """False only if the bitmaps prove that the sets are no link."""
    while len(x) > len(y):  # fewer bits: the halves on top of each other
        half = len(x) // 2
        x = (int.from_bytes(x[:half], "little") | int.from_bytes(x[half:], "little")).to_bytes(half, "little")
    while len(y) > len(x):
        half = len(y) // 2
        y = (int.from_bytes(y[:half], "little") | int.from_bytes(y[half:], "little")).to_bytes(half, "little")
    shared = -(-percent * (n_x + n_y) // (100 + percent))
    return (int.from_bytes(x, "little") ^ int.from_bytes(y, "little")).bit_count() <= n_x + n_y - 2 * shared


def _profile(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_key, bits) of every document."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, keys, bits = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
            for _, _, tokens, to in token_sets(b.column(1), k):
                n.append(np.diff(to))
                keys.append(set_keys(tokens, to))
                bits += [bitmap(tokens[i:j]) if j > i else None for i, j in zip(to[:-1], to[1:])]
            n = np.concatenate(n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n), pa.array(np.concatenate(keys), mask=n == 0),
                 pa.array(bits, pa.binary())], names=["doc_id", "text_key", "n_shingles", "set_key", "bits"])

    return docs.withColumn("text_key", text_key("text")).mapInArrow(
        run, f"doc_id {id_type}, text_key long, n_shingles long, set_key long, bits binary")


def _frequent_tokens(docs: DataFrame, k: int, ranges: int) -> np.ndarray:
    """The most frequent tokens, by their range number and 32 further bits."""
    bits = ranges.bit_length() - 1

    def blocks(held: list[np.ndarray]) -> pa.RecordBatch:
        tokens, count = np.unique(np.concatenate(held), return_counts=True)
        at = _blocks(tokens, ranges)
        rows = [(i, _rest(tokens[a:b], ranges), count[a:b].astype(np.uint32).tobytes() if (count[a:b] > 1).any() else b"")
                for i, (a, b) in enumerate(zip(at[:-1], at[1:])) if b > a]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                           *(pa.array([r[j] for r in rows], pa.binary()) for j in (1, 2))],
                                          names=["range", "tokens", "counts"])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, n = _Seen(), [], 0
        for b in batches:
            for _, _, tokens, to in token_sets(b.column(1), k):
                for r, key in enumerate(set_keys(tokens, to).tolist()):
                    if to[r + 1] > to[r] and seen.new(key):
                        held.append(tokens[to[r]:to[r + 1]])
                        n += len(held[-1])
                        if n > BLOCK:
                            yield blocks(held)
                            held, n = [], 0
        if held:
            yield blocks(held)

    def count(group: pa.Table) -> pa.Table:
        tokens = [np.frombuffer(x, np.uint32) for x in group["tokens"].to_pylist()]
        counts = [np.frombuffer(x, np.uint32) if x else np.ones(len(t), np.uint32)
                  for x, t in zip(group["counts"].to_pylist(), tokens)]
        tokens, counts = np.concatenate(tokens), np.concatenate(counts)
        order = np.argsort(tokens)
        tokens, counts = tokens[order], counts[order]
        start = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        total = np.add.reduceat(counts.astype(np.int64), start)
        token = tokens[start].astype(np.int64) + (group["range"][0].as_py() << 32)
        often = total >= FREQUENT_FROM
        return pa.table({"token": token[often], "n": total[often]})

    found = (docs.mapInArrow(collect, "range int, tokens binary, counts binary")
             .groupBy("range").applyInArrow(count, "token long, n long"))
    top = found.orderBy(F.desc("n"), "token").limit(MAX_FREQUENT).toArrow()  # bounded
    return np.sort(top["token"].to_numpy()).astype(np.uint64), _U(32 - bits)


def _indexed(docs: DataFrame, k: int, percent: int, ranges: int, tokens_sent, shift) -> DataFrame:
    """(sig, key, n, first, first_n): sets that share a signature with another,
    each with one of these others (or itself, where it is that one)."""
    names = ["range", "sig", "key", "n", "first", "first_n"]

    def blocks(held: list, number: int) -> Iterator[pa.RecordBatch]:
        sig = np.concatenate([s for s, _, _ in held])
        size = [len(s) for s, _, _ in held]
        key = np.repeat(np.array([x for _, x, _ in held], np.int64), size)
        n = np.repeat(np.array([x for _, _, x in held], np.int32), size)
        order = np.argsort(sig, kind="stable")
        sig, key, n = sig[order], key[order], n[order]
        head = np.ones(len(sig), bool)
        head[1:] = sig[1:] != sig[:-1]
        run = np.cumsum(head) - 1
        start = np.flatnonzero(head)
        several = np.diff(np.append(start, len(sig)))[run] > 1
        at = _blocks(sig[start], ranges)
        rows = [(i, _rest(sig[start[a:b]], ranges), key[start[a:b]].tobytes(), n[start[a:b]].tobytes(), None, None)
                for i, (a, b) in enumerate(zip(at[:-1], at[1:])) if b > a]
        # Sets that met in this task: kept with the first of them, dealt out by task.
        first = start[run[several]]
        short = (sig >> (_U(32) - _U(ranges.bit_length() - 1))).astype(np.int64)
        rows.append((-1 - number % ranges, short[several].tobytes(), key[several].tobytes(), n[several].tobytes(),
                     key[first].tobytes(), n[first].tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                          *(pa.array([r[j] for r in rows], pa.binary()) for j in range(1, 6))], names=names)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, n, number = _Seen(), [], 0, None
        known = tokens_sent.value
        for b in batches:
            for _, _, tokens, to in token_sets(b.column(1), k):
                short = tokens >> shift
                at = np.searchsorted(known, short)
                often = np.zeros(len(tokens), bool)
                if len(known):
                    often = known[np.minimum(at, len(known) - 1)] == short
                for r, key in enumerate(set_keys(tokens, to).tolist()):
                    lo, hi = to[r], to[r + 1]
                    # The nearest set that is not equal has one more token.
                    if 100 * (hi - lo) >= percent * (hi - lo + 1) and seen.new(key):
                        held.append((signatures(tokens[lo:hi], often[lo:hi], percent), key, hi - lo))
                        n += len(held[-1][0])
                        if n > BLOCK:
                            number = (abs(held[0][1]) if number is None else number) + 1
                            yield from blocks(held, number)
                            held, n = [], 0
        if held:
            yield from blocks(held, (abs(held[0][1]) if number is None else number) + 1)

    def meet(group: pa.Table) -> pa.Table:
        part = group["range"][0].as_py()
        take = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in group[c].to_pylist()])
        if part < 0:
            return pa.table({"sig": take("sig", np.int64), "key": take("key", np.int64), "n": take("n", np.int32),
                             "first": take("first", np.int64), "first_n": take("first_n", np.int32)})
        sig, key, n = take("sig", np.uint32), take("key", np.int64), take("n", np.int32)
        order = np.lexsort((key, sig))
        sig, key, n = sig[order], key[order], n[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
        sig, key, n = sig[new], key[new], n[new]
        head = np.ones(len(sig), bool)
        head[1:] = sig[1:] != sig[:-1]
        start = np.flatnonzero(head)
        run = np.cumsum(head) - 1
        several = np.diff(np.append(start, len(sig)))[run] > 1
        first = start[run[several]]
        return pa.table({"sig": sig[several].astype(np.int64) + (part << 32), "key": key[several], "n": n[several],
                         "first": key[first], "first_n": n[first]})

    return (docs.mapInArrow(collect, "range int, sig binary, key binary, n binary, first binary, first_n binary")
            .groupBy("range").applyInArrow(meet, "sig long, key long, n int, first long, first_n int"))


def _possible(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their bitmaps do not rule out."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(2, 6)]
            keep = pa.array([may_link(x, y, n_x, n_y, percent) for x, y, n_x, n_y in zip(*cols)], pa.bool_())
            yield b.select([0, 1]).filter(keep)

    left, right = (marks.select(F.col("key").alias(k), F.col("bits").alias(f"bits_{k}"), F.col("n").alias(f"n_{k}"))
                   for k in ("a", "b"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "bits_a", "bits_b", "n_a", "n_b")
            .mapInArrow(test, "a long, b long"))


def _wanted_sets(docs: DataFrame, keys: DataFrame, k: int) -> DataFrame:
    """(key, tokens) of the sets in ``keys``. A filter of fixed size keeps most
    other documents out of the shuffle; what it lets through is harmless."""
    spark = docs.sparkSession
    place = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    words = (keys.select(F.shiftright(place, 6).cast("int").alias("word"), F.expr(
        f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - FILTER_BITS}) & 63 as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())  # at most 2**(FILTER_BITS - 6) rows
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    sent = spark.sparkContext.broadcast(table)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, wanted = _Seen(), sent.value.view(np.uint64)
        for b in batches:
            out_keys, out_sets = [], []
            for _, _, tokens, to in token_sets(b.column(1), k):
                keys = set_keys(tokens, to)
                at = keys.view(np.uint64) >> _U(64 - FILTER_BITS)
                hit = (wanted[(at >> _U(6)).astype(np.int64)] >> (at & _U(63))) & _U(1)
                for r in np.flatnonzero((hit == 1) & (to[1:] > to[:-1])):
                    if seen.new(int(keys[r])):
                        out_keys.append(int(keys[r]))
                        out_sets.append(tokens[to[r]:to[r + 1]].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out_keys, pa.int64()), pa.array(out_sets, pa.binary())],
                                             names=["key", "tokens"])

    return docs.mapInArrow(collect, "key long, tokens binary").groupBy("key").agg(F.first("tokens").alias("tokens"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x, y, p, q in zip(*(b.column(i).to_pylist() for i in range(4))):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                shared = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * shared >= percent * (len(p) + len(q) - shared):
                    out.append((x, y, len(p), len(q), shared))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=["a", "b", "n_a", "n_b", "n_shared"])

    left = sets.select(F.col("key").alias("a"), F.col("tokens").alias("tokens_a"))
    right = sets.select(F.col("key").alias("b"), F.col("tokens").alias("tokens_b"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "tokens_a", "tokens_b")
            .mapInArrow(compare, "a long, b long, n_a long, n_b long, n_shared long"))


# Difference tokens that the centre has and the set lacks are marked by this constant.
_MISSING = textvec.MIX[59]


def _clusters(members: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, n, cluster, center) of the sets in clusters of more than GROUP sets.
    ``members`` (sig, key, n, ...) lists sets that share signatures. A set goes with the
    first set of SHARED or more of its signatures (fewer may be chance, and would chain
    families of copies together); the centre is the one that most sets go with."""
    first = members.groupBy("sig").agg(F.min("key").alias("first"))
    edges = scratch.table(members.join(first, "sig").where("key <> first").groupBy("key", "first").agg(
        F.count("*").alias("shared")).where(F.col("shared") >= SHARED).select(
        F.col("key").alias("u"), F.col("first").alias("v")), "edges")
    part = scratch.table(components(edges, scratch).select(F.col("node").alias("key"), F.col("component").alias("cluster")),
                         "clusters")
    center = (edges.groupBy(F.col("v").alias("key")).agg(F.count("*").alias("size")).join(part, "key")
              .groupBy("cluster").agg(F.max_by("key", F.struct("size", "key")).alias("center")))
    large = part.groupBy("cluster").agg(F.count("*").alias("sets")).where(F.col("sets") > GROUP)
    return scratch.table(part.join(large, "cluster").join(center, "cluster").join(
        members.select("key", "n").distinct(), "key").select("key", "n", "cluster", "center"), "clustered")


def _differences(clustered: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, n, cluster, center, n_center, d, tokens): the differences of clustered sets
    from their centre, of those whose difference is no larger than the set itself."""
    of_center = clustered.select("cluster", "center").distinct().join(
        sets.select(F.col("key").alias("center"), F.col("tokens").alias("of_center")), "center").drop("center")
    rows = (clustered.join(sets.hint("merge"), "key").join(of_center.hint("merge"), "cluster")
            .select("key", "n", "cluster", "center", "tokens", "of_center"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, n_center = [], []
            for x, c in zip(b.column(4).to_pylist(), b.column(5).to_pylist()):
                x, c = np.frombuffer(x, np.uint64), np.frombuffer(c, np.uint64)
                more, less = np.setdiff1d(x, c, assume_unique=True), np.setdiff1d(c, x, assume_unique=True)
                out.append(np.concatenate((more, less ^ _MISSING)).view(np.int64))
                n_center.append(len(c))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(4)), pa.array(n_center, pa.int32()),
                 pa.array([len(x) for x in out], pa.int32()), pa.array(out, pa.list_(pa.int64()))],
                names=["key", "n", "cluster", "center", "n_center", "d", "tokens"])

    return rows.mapInArrow(run, "key long, n int, cluster long, center long, n_center int, d int, tokens array<long>"
                           ).where("d <= n")


def _links_center(percent: int) -> Column:
    return (100 + percent) * F.col("d") <= (100 - percent) * (F.col("n") + F.col("n_center"))


def _near_center(apart: DataFrame, percent: int) -> DataFrame:
    """The sets that link with the centre of their cluster, as links."""
    near = apart.where((F.col("key") != F.col("center")) & _links_center(percent))
    first = F.col("key") < F.col("center")
    n, n_center = F.col("n").cast("long"), F.col("n_center").cast("long")
    return near.select(
        F.least("key", "center").alias("a"), F.greatest("key", "center").alias("b"),
        F.when(first, n).otherwise(n_center).alias("n_a"), F.when(first, n_center).otherwise(n).alias("n_b"),
        ((n + n_center - F.col("d")) / 2).cast("long").alias("n_shared"))


def _prefixes(apart: DataFrame, percent: int) -> DataFrame:
    """(cluster, token, key, n, d, component, indexed, members): the first tokens of
    each difference, rare ones of the cluster first, as long as a link must share one;
    ``indexed`` are those that suffice for the smaller difference. Tokens that no set of
    another component has take their places in the prefix, but have no rows."""
    tokens = apart.select("cluster", "key", F.explode("tokens").alias("token"))
    often = tokens.groupBy("cluster", "token").agg(F.count("*").alias("held")).where("held > 1")
    rare_first = W.partitionBy("key").orderBy("held", "token")
    placed = (tokens.join(often, ["cluster", "token"])
              .withColumn("nth", F.row_number().over(rare_first))
              .withColumn("common", F.count("*").over(W.partitionBy("key"))))
    most = F.col("n") * (100 - percent) / percent  # largest |X ^ Y| of a link
    place = F.col("d") - F.col("common") + F.col("nth")
    rows = (placed.join(apart.select("key", "n", "d", "component"), "key")
            .where(place <= F.floor(most) + 1).withColumn("indexed", place <= F.floor(most / 2) + 1))
    groups = (rows.groupBy("cluster", "token").agg(F.count("*").alias("members"), F.min("component").alias("least"),
                                                   F.max("component").alias("most"))
              .where("least <> most").select("cluster", "token", "members"))
    return rows.join(groups, ["cluster", "token"]).select(
        "cluster", "token", "key", "n", "d", "component", "indexed", "members")


def _prefix_pairs(prefix: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share a prefix token."""
    side = prefix.where("indexed").select("cluster", "token", F.col("key").alias("first"), F.col("n").alias("first_n"),
                                          F.col("d").alias("first_d"), F.col("component").alias("other"))
    (a, b), close = _pair("key", "first", percent, "n", "first_n")
    larger = (F.col("d") > F.col("first_d")) | ((F.col("d") == F.col("first_d")) & (F.col("key") > F.col("first")))
    near = (100 + percent) * (F.col("d") - F.col("first_d")) <= (100 - percent) * (F.col("n") + F.col("first_n"))
    return (prefix.join(side, ["cluster", "token"]).where(larger & near & close & (F.col("component") != F.col("other")))
            .select(a, b).distinct())


def _tiled(large: DataFrame, apart: DataFrame, percent: int) -> DataFrame:
    """Links between the sets of large groups of one prefix token. A group is dealt to
    tiles of about TILE sets; each task compares two tiles through the overlaps of their
    differences and returns the links of a spanning forest, at most one a set."""
    tiles = F.ceil(F.col("members") / TILE).cast("int")
    own = F.pmod(F.xxhash64("key", "token"), tiles).cast("int")
    dealt = (large.withColumn("tiles", tiles).withColumn("own", own)
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .select("cluster", "token", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "key"))
    rows = dealt.join(apart.select("key", "n", "d", "component", "tokens").hint("merge"), "key")

    def compare(group: pa.Table) -> pa.Table:
        key, n, d, component = (group[c].to_numpy() for c in ("key", "n", "d", "component"))
        held = group["tokens"].combine_chunks()
        flat, row = held.flatten().to_numpy(), np.repeat(np.arange(len(key)), d)
        token, at, often = np.unique(flat, return_inverse=True, return_counts=True)
        shared = np.zeros((len(key), len(key)), np.float32)
        several = often[at] > 1
        row, at = row[several], np.unique(at[several], return_inverse=True)[1]
        for low in range(0, int(at.max(initial=-1)) + 1, 4096):
            part = (at >= low) & (at < low + 4096)
            marks = np.zeros((len(key), 4096), np.float32)
            marks[row[part], at[part] - low] = 1
            shared += marks @ marks.T
        apart_by = d[:, None] + d[None, :] - 2 * shared.astype(np.int64)
        total = n[:, None].astype(np.int64) + n[None, :]
        linked = ((100 + percent) * apart_by <= (100 - percent) * total) & (component[:, None] != component[None, :])
        out, reached = [], np.zeros(len(key), bool)
        for start in np.flatnonzero(linked.any(axis=1)).tolist():
            if reached[start]:
                continue
            reached[start] = True
            todo = [start]
            while todo:
                x = todo.pop()
                for y in np.flatnonzero(linked[x] & ~reached).tolist():
                    reached[y] = True
                    todo.append(y)
                    p, q = (x, y) if key[x] < key[y] else (y, x)
                    out.append((key[p], key[q], n[p], n[q], (total[p, q] - apart_by[p, q]) // 2))
        cols = list(zip(*out)) or [()] * 5
        return pa.table([pa.array([int(v) for v in c], pa.int64()) for c in cols], names=["a", "b", "n_a", "n_b", "n_shared"])

    return (rows.groupBy("cluster", "token", "i", "j").applyInArrow(
        compare, "a long, b long, n_a long, n_b long, n_shared long").distinct())


def _pair(x: str, y: str, percent: int, n_x: str, n_y: str) -> tuple:
    """Ordered pair columns, and the condition that the sizes allow a link."""
    close = 100 * F.least(F.col(n_x), F.col(n_y)) >= percent * F.greatest(F.col(n_x), F.col(n_y))
    return (F.least(F.col(x), F.col(y)).alias("a"), F.greatest(F.col(x), F.col(y)).alias("b")), close


def join_documents(docs: DataFrame, k: int = 5, percent: int = 80, every_link: bool = False,
                   id_col: str = "doc_id", text_col: str = "text") -> Joined:
    """Link documents whose sets of k-word shingles have a Jaccard similarity of
    at least ``percent`` / 100, and find the components of the links.

    Words are runs of anything but ASCII white space, A-Z lower-cased. A text of
    fewer than k words is one shingle. ``links`` holds pairs between classes of
    equal sets (``documents`` has the membership): with ``every_link`` all of
    them, else those the components were found by.

    Edge cases: null texts and texts without words have no set and are alone in
    their component; documents with equal sets, repeated rows included, share a
    component; the component id is the least doc_id (null only if all ids of the
    component are null); other columns are not read; empty tables give empty
    results.
    """
    spark = docs.sparkSession
    text_batches(spark)
    scratch = Scratch(spark, "jaccard")
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    profile = scratch.table(_profile(thin, k), "profile")
    marks = scratch.table(profile.where("set_key is not null").groupBy(F.col("set_key").alias("key")).agg(
        F.first("n_shingles").alias("n"), F.first("bits").alias("bits")), "marks")
    total = profile.agg(F.sum("n_shingles")).first()[0] or 0
    ranges = 1 << max(int(total // RANGE).bit_length(), (2 * parallelism(spark)).bit_length())
    frequent, shift = _frequent_tokens(thin, k, ranges)
    sent = spark.sparkContext.broadcast(frequent)
    shared = scratch.table(_indexed(thin, k, percent, ranges, sent, shift), "shared")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        possible = scratch.table(_possible(pairs, marks, percent), f"{name}-possible")
        keys = possible.select(F.col("a").alias("key")).union(possible.select("b")).distinct()
        sets = scratch.table(_wanted_sets(thin, keys, k), f"{name}-sets")
        out = scratch.table(_verified(possible, sets, percent), name)
        scratch.drop(possible, sets)
        return out

    (a, b), close = _pair("key", "first", percent, "n", "first_n")
    if every_link:
        x, y = shared.select("sig", "key", "n").distinct(), shared.select(
            "sig", F.col("key").alias("first"), F.col("n").alias("first_n")).distinct()
        found = [verified(x.join(y, "sig").where(F.col("key") < F.col("first")).where(close).select(a, b).distinct(), "links")]
    else:
        pairs = scratch.table(shared.where("key <> first").where(close).select(a, b).distinct(), "pairs")
        found = [verified(pairs, "found")]
        tested = [pairs]

        def untested(new: DataFrame) -> DataFrame:
            return reduce(lambda left, old: left.join(old, ["a", "b"], "left_anti"), tested, new)

        def unjoined(name: str) -> DataFrame:
            """The sets of signatures whose sets are not all in one component yet."""
            links = reduce(DataFrame.union, found)
            part = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")), scratch)
            members = scratch.table(
                shared.select("sig", "key", "n").distinct().join(part.withColumnRenamed("node", "key"), "key", "left")
                .withColumn("component", F.coalesce("component", "key")), f"{name}-members")
            mixed = (members.groupBy("sig").agg(F.min("component").alias("least"), F.max("component").alias("most"))
                     .where("least <> most").select("sig", "least"))
            return scratch.table(members.join(mixed, "sig"), name)

        # What is left: sets of different components that share a signature. Those of
        # large clusters are compared by their differences, others (few) pair by pair.
        open_ = unjoined("open")
        clustered = _clusters(open_, scratch)
        sets = scratch.table(_wanted_sets(thin, clustered.select("key"), k), "clustered-sets")
        component = open_.select("key", "component").distinct()
        apart = scratch.table(_differences(clustered, sets).join(component, "key"), "differences")
        found.append(scratch.table(_near_center(apart, percent), "centered"))
        both = open_.drop("least").join(apart.select("key", "cluster"), "key", "left").withColumn(
            "cluster", F.coalesce("cluster", "key"))
        other = both.select("sig", F.col("key").alias("first"), F.col("n").alias("first_n"),
                            F.col("component").alias("other"), F.col("cluster").alias("other_cluster"))
        met = both.join(other, "sig").where(F.col("component") < F.col("other")).where(
            F.col("cluster") != F.col("other_cluster")).where(close).select(a, b).distinct()
        tested.append(scratch.table(untested(met), "met"))
        found.append(verified(tested[-1], "found1"))
        # Links with the centre, already found, leave these sets in its component.
        centers = component.select(F.col("key").alias("center"), F.col("component").alias("of_center"))
        apart = scratch.table(apart.join(centers, "center").withColumn("component", F.when(
            _links_center(percent), F.col("of_center")).otherwise(F.col("component"))), "apart")
        prefix = scratch.table(_prefixes(apart, percent), "prefixes")
        large = prefix.where(F.col("members") > GROUP)
        met = _prefix_pairs(prefix.where(F.col("members") <= GROUP), percent)
        found.append(verified(scratch.table(untested(met), "met2"), "found2"))
        found.append(scratch.table(_tiled(large, apart, percent), "tiled"))
    links = reduce(DataFrame.union, found)
    part = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")), scratch)
    root = scratch.table(profile.join(part.withColumnRenamed("node", "set_key"), "set_key", "left").select(
        "doc_id", "text_key", "n_shingles", "set_key", F.coalesce("component", "set_key").alias("component_key")), "root")
    least = scratch.table(root.where("component_key is not null").groupBy("component_key")
                          .agg(F.min("doc_id").alias("component_id")), "ids")
    documents = root.join(least, "component_key", "left").select(
        "doc_id", "text_key", "n_shingles", "set_key", "component_key",
        F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    scratch.finish(root, least, *found)
    return Joined(documents, links)


def first_of_components(docs: DataFrame, joined: Joined, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, the one with the least
    id (a null id comes last, of equal ids the least text key), and every row
    without words.

    Rows are told by id and text. The texts that go, and those of which equal rows
    exist, are listed; the list is sent to every task while a count shows that it is
    short, so that the texts are not shuffled, else the join is a merge join."""
    scratch = Scratch(docs.sparkSession, "first")
    doc, key, own, stays, nth = free_names(docs, "listed_id", "listed_key", "own_key", "stays", "nth")
    rows = joined.documents.where("set_key is not null")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")
    first = rows.groupBy("component_key").agg(F.min(order).alias("first"))
    listed = scratch.table(
        rows.groupBy("doc_id", "text_key").agg(F.count("*").alias("n"), F.first("component_key").alias("component_key"))
        .join(first, "component_key").withColumn("stays", (F.col("first.doc_id").eqNullSafe(F.col("doc_id")))
                                                 & (F.col("first.text_key") == F.col("text_key")))
        .where("not stays or n > 1").select(F.col("doc_id").alias(doc), F.col("text_key").alias(key),
                                            F.col("stays").alias(stays)), "listed")
    side = F.broadcast(listed) if at_most(listed, THIN_ROWS) else listed.hint("merge")
    names = [f"`{c}`" for c in docs.columns]
    found = docs.withColumn(own, text_key(text_col)).join(
        side, F.col(id_col).eqNullSafe(F.col(doc)) & (F.col(own) == F.col(key)), "left")
    single = found.where(F.col(stays).isNull()).select(*names)
    repeated = found.where(F.col(stays)).withColumn(nth, F.row_number().over(W.partitionBy(doc, key).orderBy(own)))
    return single.unionByName(repeated.where(F.col(nth) == 1).select(*names))

"""LM scoring with a probabilistic suffix tree over words.

States are contexts of up to ``depth`` words. A context is a candidate when the
training texts hold it at least ``min_count`` times, and it is retained by a
divergence test: over its occurrences in training, the summed log-ratio of its own
next-symbol distribution (with the occurrence itself left out) to that of its longest
retained suffix must exceed ``min_gain``. A context that only repeats what its suffix
predicts, or that was seen with too few repeats to predict anything, falls.

Distributions are smoothed along the suffixes: the root has (c + 1) / (N + V + 1), a
state s after its retained suffix r has
P(a | s) = (n(s, a) + prior * P(a | r)) / (n(s) + prior). A symbol is scored in the
state of the longest retained suffix of what precedes it; a text starts at the root.

Execution. The texts become blocks of about ``BLOCK`` tokens (distinct word hashes and
positions among them, compressed). The model is never gathered: a block sends its
distinct n-grams, with their counts in training texts, to hash ranges as packed
arrays; the ranges add them up and send the sums back in the same order. So one
exchange both counts a level of the tree over the whole corpus and answers each block
what it needs to score. A hot n-gram is one entry a block. Divergence sums travel the
same way, as integers, so results don't depend on the blocks. Beyond pairs of words,
level by level, only extensions of candidate contexts are sent.

Words are told by 64-bit hashes; longer n-grams by their range and 40 further bits of a
64-bit hash. Among 10**9 distinct words a collision is expected with probability 0.03;
two of the about 10**6 n-grams of a range collide with a probability of 10**-6 for each
n-gram, which then has a slightly higher count in the model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeq.llm import textvec
from lakeq.llm.common import Scratch, parallelism, text_batches

BLOCK = 1 << 20           # tokens of a block, about: a longer text is a block of its own
RANGE = 1 << 20           # n-grams of a hash range, about
UNIT = 1 << 16            # divergence sums are integers, in units of 1 / UNIT nats
END = np.uint64(0x9E3779B97F4A7C15)  # hash of the end token

_U = np.uint64


_COMPRESSOR, _DECOMPRESSOR = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _shrink(data: bytes) -> bytes:
    return _COMPRESSOR.compress(data)


def _grow(data: bytes) -> bytes:
    return _DECOMPRESSOR.decompress(data)


def _planes(values: np.ndarray, size: int) -> bytes:
    """The lowest ``size`` bytes of each number, compressed: all lowest bytes, then all second
    ones and so on, as high bytes are alike and most counts are small, whatever the largest is."""
    if size == 1:
        return _shrink(values.astype(np.uint8).tobytes())
    return _shrink(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes())


def _numbers(data: bytes, size: int) -> np.ndarray:
    rows = np.frombuffer(_grow(data), np.uint8).reshape(size, -1)
    if size == 1:
        return rows[0].astype("<u8")
    out = np.zeros((rows.shape[1], 8), np.uint8)
    out[:, :size] = rows.T
    return out.reshape(-1).view("<u8")


def _bytes(most: int) -> int:
    return max(1, -(-most.bit_length() // 8))


def pack(values: np.ndarray) -> bytes:
    """Integers in as few bytes as the largest needs; the first byte tells how many, and
    whether (8 more) some are below 0."""
    if not len(values):
        return b""
    signed = bool(values.min() < 0)
    # numbers below 0 become odd ones, the others even ones, so that small ones stay short
    coded = ((values << 1) ^ (values >> 63)).view(np.uint64) if signed else values
    size = _bytes(int(coded.max()))
    return bytes([size + 8 * signed]) + _planes(coded, size)


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    signed, size = divmod(data[0] - 1, 8)
    out = _numbers(data[1:], size + 1)
    return (out >> _U(1)).astype(np.int64) ^ -(out & _U(1)).astype(np.int64) if signed else out.astype(np.int64)


def _gaps(values: np.ndarray) -> bytes:
    """Rising numbers as the first and the gaps between them. Only the highest byte of a
    gap is worth compressing, the others are as good as random."""
    if not len(values):
        return b""
    gaps = np.diff(values)
    size = _bytes(int(gaps.max(initial=0)))
    raw = gaps.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
    return (bytes([size]) + values[:1].astype("<u8").tobytes() + raw[:, :size - 1].tobytes()
            + _shrink(raw[:, size - 1].tobytes()) + len(gaps).to_bytes(4, "little"))


def _ungaps(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    size, first = data[0], np.frombuffer(data, "<u8", count=1, offset=1)
    n = int.from_bytes(data[-4:], "little")
    low = 9 + n * (size - 1)
    gaps = np.zeros((n, 8), np.uint8)
    gaps[:, :size - 1] = np.frombuffer(data, np.uint8, count=n * (size - 1), offset=9).reshape(n, size - 1)
    gaps[:, size - 1] = np.frombuffer(_grow(data[low:-4]), np.uint8)
    return np.cumsum(np.concatenate((first, gaps.reshape(-1).view("<u8"))), dtype=np.uint64)


def _keys(h: np.ndarray, whole: bool, bits: int) -> bytes:
    """Sorted hashes of one range, which is their first ``bits``: whole, or the 40 bits
    that follow (equal ones stay apart, in order)."""
    return _gaps(h if whole else (h << _U(bits)) >> _U(24))


class Block:
    """The tokens of some texts, an end token after each."""

    def __init__(self, words: np.ndarray, codes: np.ndarray, per_text: np.ndarray, training: np.ndarray):
        self.words, self.codes, self.per_text = words, codes, per_text
        self.text = np.repeat(np.arange(len(per_text)), per_text)
        self.training = training[self.text]
        first = np.cumsum(per_text) - per_text
        self.place = np.arange(len(codes)) - first[self.text]  # tokens before it in its text

    def grams(self, order: int, at: np.ndarray) -> np.ndarray:
        """Hashes of the n-grams that end at positions ``at`` (each has order - 1 tokens before it)."""
        h = self.words[self.codes[at]]
        if order == 1:
            return h
        out = np.full(len(at), order, np.uint64) * textvec.MIX[40]
        for j in range(order):
            out += self.words[self.codes[at - j]] * textvec.MIX[41 + j]
        return textvec.mix(out)


class Level:
    """What a block asks about one kind of n-gram: the sums of ``values`` over all
    blocks for each distinct key at positions ``at``."""

    def __init__(self, keys: np.ndarray, ranges: int):
        self.distinct, self.inverse = np.unique(keys, return_inverse=True)
        self.bits = bits = ranges.bit_length() - 1
        edges = np.arange(1, ranges, dtype=np.uint64) << _U(64 - bits) if bits else np.zeros(0, np.uint64)
        self.cut = np.concatenate(([0], np.searchsorted(self.distinct, edges, "left"), [len(self.distinct)]))

    def ask(self, kind: int, values: np.ndarray, whole: bool) -> Iterator[tuple[int, int, bytes, bytes]]:
        """(kind, range, keys, values) for each range that has keys; ``values`` by position."""
        sums = np.zeros(len(self.distinct), np.int64)
        np.add.at(sums, self.inverse, values)
        for r in np.flatnonzero(np.diff(self.cut)).tolist():
            a, b = self.cut[r], self.cut[r + 1]
            yield kind, r, _keys(self.distinct[a:b], whole, self.bits), pack(sums[a:b])

    def answer(self, got: dict[int, bytes]) -> np.ndarray:
        """The answered sums, by position."""
        if not len(self.distinct):
            return np.zeros(0, np.int64)
        return np.concatenate([unpack(got[r]) for r in sorted(got)])[self.inverse]


# Kinds of n-grams asked about: counts of order L are L, divergence sums of contexts of
# length L are GAIN + L.
GAIN = 100


class Model:
    """The numbers that all tasks share."""

    def __init__(self, depth: int, min_count: int, min_gain: float, prior: float, ranges: dict[int, int],
                 tokens: int = 0, distinct: int = 0, known: frozenset = frozenset()):
        self.depth, self.min_count, self.min_gain, self.prior = depth, min_count, min_gain, prior
        self.ranges, self.tokens, self.distinct = ranges, tokens, distinct
        self.known = known  # kinds answered so far


class Walk:
    """A block's positions followed down the tree as far as answers are known."""

    def __init__(self, block: Block, model: Model, answers: dict[int, dict[int, bytes]]):
        self.block, self.model = block, model
        every = np.arange(len(block.codes))
        self.asks: list[tuple[int, Level, np.ndarray, bool]] = []
        follows = every[block.place >= 1]
        one = Level(block.grams(1, every), model.ranges[1])
        two = Level(block.grams(2, follows), model.ranges[2])
        if 1 not in answers:
            self.asks += [(1, one, block.training, True), (2, two, block.training[follows], False)]
            return
        self.count = one.answer(answers[1])
        base = (self.count + 1.0) / (model.tokens + model.distinct + 1.0)
        self.base = np.log10(base)
        p = base.copy()
        n_context = self.count       # training count of the n-gram that ends at each position
        at = every                   # positions followed so far
        for order in range(1, model.depth + 1):
            # Contexts of this length: the n-gram that ends before a position.
            before = np.zeros(len(every), np.int64)
            before[at] = n_context
            at = at[block.place[at] >= order]
            n_context = before[at - 1]
            keep = n_context >= model.min_count
            if order == 1:
                n = two.answer(answers[2])[keep]
                at, n_context = at[keep], n_context[keep]
            else:
                at, n_context = at[keep], n_context[keep]
                n = Level(block.grams(order + 1, at), model.ranges[order + 1]).answer(answers[order + 1])
            contexts = Level(block.grams(order, at - 1), model.ranges[order])
            if GAIN + order not in answers:
                own = block.training[at]
                q = p[at]
                out = np.where(own, np.log((np.maximum(n - 1, 0) + model.prior * q) / (n_context - 1 + model.prior) / q), 0.0)
                self.asks.append((GAIN + order, contexts, np.rint(out * UNIT).astype(np.int64), order == 1))
                if order < model.depth:
                    # The next level's counts need only candidates, so they go along.
                    deeper = np.zeros(len(every), np.int64)
                    deeper[at] = n
                    nxt = at[block.place[at] >= order + 1]
                    nxt = nxt[deeper[nxt - 1] >= model.min_count]
                    self.asks.append((order + 2, Level(block.grams(order + 2, nxt), model.ranges[order + 2]),
                                      block.training[nxt], False))
                return
            retained = contexts.answer(answers[GAIN + order]) > model.min_gain * UNIT
            r = at[retained]
            p[r] = (n[retained] + model.prior * p[r]) / (n_context[retained] + model.prior)
            n_context = n
        self.score = np.log10(p)


def is_training(id_col: Column, folds: int, held_out: int) -> Column:
    """crc32 of the id's text modulo ``folds`` is not ``held_out``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds != held_out


def _blocks(docs: DataFrame) -> DataFrame:
    """(block, ids, training, words, codes, per_text): tokenised texts, some ``BLOCK`` tokens a row."""
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list = []
        size = 0

        def block() -> pa.RecordBatch:
            nonlocal number
            words, codes = np.unique(np.concatenate([h for h, _, _, _ in held]), return_inverse=True)
            per_text = np.concatenate([n for _, n, _, _ in held])
            number += 1
            return pa.RecordBatch.from_arrays([
                pa.array([number]), pa.array([pa.concat_arrays([i for _, _, i, _ in held]).to_pylist()], pa.list_(ids)),
                pa.array([np.concatenate([t for _, _, _, t in held]).tobytes()], pa.binary()),
                pa.array([_gaps(words)], pa.binary()),
                pa.array([_shrink(codes.astype(np.int32).tobytes())], pa.binary()),
                pa.array([per_text.astype(np.int64).tobytes()], pa.binary())],
                names=["block", "ids", "training", "words", "codes", "per_text"])

        for b in batches:
            ids = b.column(0).type
            training = b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for at, last, data, offs in textvec.slices(b.column(1)):
                low = textvec.lower(data)
                start, end = textvec.words(low, offs)
                h = textvec.span_hash(textvec.rolling(low), start, end)
                per = np.bincount(textvec.row_of(offs, start), minlength=last - at)
                held.append((np.insert(h, np.cumsum(per), END), per + 1, b.column(0)[at:last], training[at:last]))
                size += len(h) + last - at
                if size >= BLOCK:
                    yield block()
                    held, size = [], 0
        if held:
            yield block()

    return docs.mapInArrow(run, f"block long, ids array<{id_type.simpleString()}>, training binary, words binary, "
                                "codes binary, per_text binary")


def _block(row: dict) -> Block:
    codes = np.frombuffer(_grow(row["codes"]), np.int32)
    return Block(_ungaps(row["words"]), codes, np.frombuffer(row["per_text"], np.int64),
                 np.frombuffer(row["training"], bool))


ASKED = "kind int, part int, block long, keys binary, sums binary"
ANSWERED = "block long, kind int, part int, sums binary"


def _asked(walk: Walk, number: int) -> pa.Table:
    rows = [(kind, part, number, keys, sums) for kind, level, values, whole in walk.asks
            for kind, part, keys, sums in level.ask(kind, values, whole)]
    cols = list(zip(*rows)) or [()] * 5
    types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=["kind", "part", "block", "keys", "sums"])


def _answers(asked: DataFrame) -> DataFrame:
    """Sums over all blocks, back to each block in the order of its keys; with kind 1
    also (block -1) how many keys have a sum and the sum of all, of each range."""

    def add(group: pa.Table) -> pa.Table:
        kind, part = group["kind"][0].as_py(), group["part"][0].as_py()
        keys = [_ungaps(k) for k in group["keys"].to_pylist()]
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.zeros(len(distinct), np.int64)
        np.add.at(sums, inverse, np.concatenate([unpack(s) for s in group["sums"].to_pylist()]))
        back = sums[inverse]
        to = np.cumsum([0] + [len(k) for k in keys])
        blocks = group["block"].to_pylist()
        out = [pack(back[a:b]) for a, b in zip(to[:-1], to[1:])]
        if kind == 1:
            blocks.append(-1)
            out.append(pack(np.array([(sums > 0).sum(), sums.sum()], np.int64)))
        return pa.table([pa.array(blocks, pa.int64()), pa.array([kind] * len(out), pa.int32()),
                         pa.array([part] * len(out), pa.int32()), pa.array(out, pa.binary())],
                        names=["block", "kind", "part", "sums"])

    return asked.groupBy("kind", "part").applyInArrow(add, ANSWERED)


def _walk(row: dict, answered: pa.Table, model: Model) -> Walk:
    answers: dict[int, dict[int, bytes]] = {}
    for kind, part, sums in zip(*(answered[c].to_pylist() for c in ("kind", "part", "sums"))):
        answers.setdefault(kind, {})[part] = sums
    for kind in model.known:  # a block without n-grams of a kind has asked nothing
        answers.setdefault(kind, {})
    return Walk(_block(row), model, answers)


def _go_on(model: Model) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """What a block asks next, of the block and its answers."""

    def run(block: pa.Table, answered: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        return _asked(_walk(row, answered, model), row["block"])

    return run


def score(docs: DataFrame, depth: int = 2, min_count: int = 8, min_gain: float = 2.0, prior: float = 4.0,
          folds: int = 7, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every
    row: log10 probabilities under the unigram base and under the suffix tree learned
    from the rows whose id falls outside the held-out fold.

    Tokens are runs of anything but ASCII white space, A-Z lower-cased, then one end.

    Edge cases: a null or empty text is its end token alone; a null id counts as empty
    text in the fold; repeated rows are texts of their own, all learned from; without
    training texts every probability is 1 / (0 + 0 + 1); other columns are not read;
    an empty table gives an empty result. A block, and so a task, holds one whole text
    at least: memory grows with the longest text, some 150 bytes a word.
    """
    if depth < 1:
        raise ValueError("a suffix tree has contexts of one word at least")
    spark = docs.sparkSession
    text_batches(spark)
    scratch = Scratch(spark, "suffix-tree")
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       is_training(F.col(id_col), folds, held_out).alias("training"))
    blocks = scratch.table(_blocks(thin), "blocks")
    size = blocks.agg(F.count("*").alias("blocks"), F.sum(F.length("words") / 5).alias("words")).first()
    least = (2 * parallelism(spark)).bit_length()

    def ranges(entries: float) -> int:
        return 1 << min(24, max(int(entries // RANGE).bit_length(), least))

    tokens = (size["blocks"] or 0) * BLOCK
    setup = (depth, min_count, min_gain, prior,
             {order: ranges((size["words"] or 0) if order == 1 else tokens) for order in range(1, depth + 2)})

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                yield from _asked(Walk(_block(row), Model(*setup), {}), row["block"]).to_batches()

    answers = [scratch.table(_answers(blocks.mapInArrow(start, ASKED)), "counts1")]
    totals = [unpack(r["sums"]) for r in answers[0].where("block = -1").select("sums").collect()]  # one row a range
    size_of = (int(sum(t[1] for t in totals)), int(sum(t[0] for t in totals)))
    model = Model(*setup, *size_of, frozenset({1, 2}))

    def together(run, types: str) -> DataFrame:
        got = answers[0].where("block >= 0")
        for a in answers[1:]:
            got = got.union(a)
        return blocks.groupBy("block").cogroup(got.groupBy("block")).applyInArrow(run, types)

    # Each step sends what the last answers allow: the divergence sums of one more
    # length of contexts and counts of their extensions.
    for step in range(1, depth + 1):
        answers.append(scratch.table(_answers(together(_go_on(model), ASKED)), f"step{step}"))
        model = Model(*setup, *size_of, frozenset([*range(1, min(step + 1, depth) + 2), *range(GAIN + 1, GAIN + step + 1)]))
    scratch.finish(blocks, *answers)

    def finish(block: pa.Table, answered: pa.Table) -> pa.Table:
        row = block.select([c for c in block.column_names if c != "ids"]).to_pylist()[0]
        walk = _walk(row, answered, model)
        n = walk.block.per_text
        first = np.cumsum(n) - n
        ids = block["ids"].combine_chunks().flatten()
        add = lambda x: np.add.reduceat(x, first)
        return pa.table([
            ids, pa.array(~np.frombuffer(row["training"], bool)), pa.array(n),
            pa.array(add((walk.count > 0).astype(np.int64))), pa.array(np.full(len(n), model.tokens, np.int64)),
            pa.array(add(walk.base)), pa.array(add(walk.score))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return together(finish, f"doc_id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, n_tokens long, "
                            "n_known long, train_tokens long, base_score double, score double")

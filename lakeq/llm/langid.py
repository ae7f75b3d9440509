"""Language ID by error-correcting output codes.

Every language has a codeword of bits. One binary classifier per bit (logistic,
over hashed character n-grams, all trained together by numpy stochastic gradient
descent) predicts that bit for a text; decoding adds up, for each codeword, the
logistic loss of its bits against the predicted margins and picks the least. The
gap to the second codeword flags ambiguous texts.

Training sees at most ``PER_LANGUAGE`` documents of a language, with their whole
texts. Every whole text of the corpus is then scored in one map, without a
shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeq.llm import learn, textvec
from lakeq.llm.common import free_names, text_batches

BITS = 16
SIZES = (1, 2, 3)
EPOCHS = 5
RATE = 20.0
PER_LANGUAGE = 1000
AMBIGUOUS_BELOW = 0.2  # gap between the best and second codeword's probability

# Bytes of letters stay (any byte of a multi-byte character counts as one), all else is a gap.
_LETTER = np.full(256, 32, np.uint8)
for _c in (*range(97, 123), *range(128, 256)):
    _LETTER[_c] = _c


def codewords(k: int) -> np.ndarray:
    """k codewords of +1 and -1: all splits in two for up to 6 languages, else
    columns drawn at random (fixed seed), 10 for each binary digit of k."""
    if k <= 1:
        return np.ones((k, 1))
    if k <= 6:
        splits = np.arange(1, 2 ** (k - 1))
        return np.array([np.where(splits >> (k - 1 - c) & 1, 1, -1) for c in range(k)], float)
    rng = np.random.Generator(np.random.PCG64(k))
    columns: set[tuple[int, ...]] = set()
    while len(columns) < 10 * (k - 1).bit_length():
        c = rng.permutation(np.where(np.arange(k) % 2, 1, -1))
        columns.add(tuple(int(x) for x in c * c[0]))
    return np.array(sorted(columns), float).T


def squeezed(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of lower-cased text, one space for each gap, a space around each row."""
    flat = _LETTER[data]
    keep = flat != 32
    keep[1:] |= flat[:-1] != 32
    keep[:1] = True
    keep[offs[:-1][offs[:-1] < len(data)]] = True
    kept = np.concatenate(([0], np.cumsum(keep)))
    return flat[keep], kept[offs]


@dataclass
class Model:
    langs: list[str]
    codes: np.ndarray    # languages x bits
    weight: np.ndarray   # buckets x bits
    bias: np.ndarray

    def margins(self, col: pa.Array) -> np.ndarray:
        """Documents x bits."""
        out = [np.zeros((0, self.weight.shape[1]))]
        for at, end, data, offs in textvec.slices(col, textvec.SLICE_BYTES // 2):
            flat, to = squeezed(data, offs)
            total, n = np.zeros((end - at, self.weight.shape[1])), np.zeros((end - at, 1))
            for size in SIZES:
                total += textvec.row_sums(self.weight[textvec.ngrams(flat, size, BITS)], to, size)
                n += np.maximum(np.diff(to)[:, None] - size + 1, 0)
            out.append(total / np.maximum(n, 1) + self.bias)
        return np.concatenate(out)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, probability and gap to the second language."""
        loss = np.logaddexp(0, -margins[:, None, :] * self.codes[None]).sum(2)
        p = np.exp(-(loss - loss.min(1, keepdims=True)))
        p /= p.sum(1, keepdims=True)
        top = np.sort(p, 1)
        second = top[:, -2] if p.shape[1] > 1 else np.zeros(len(p))
        return p.argmax(1), top[:, -1], top[:, -1] - second


def fit(targets: list, texts: pa.ChunkedArray) -> Model:
    langs = sorted(set(targets))
    codes = codewords(len(langs))
    width = codes.shape[1] if langs else 1
    weight, bias = np.zeros((1 << BITS, width), np.float32), np.zeros(width, np.float32)
    docs = learn.Bags()
    for chunk in texts.chunks:
        for at, end, data, offs in textvec.slices(chunk):
            flat, to = squeezed(data, offs)
            found = [(textvec.ngrams(flat, n, BITS), n) for n in SIZES]
            for r in range(end - at):
                docs.add(np.concatenate([textvec.row_values(b, to, n, r) for b, n in found]))
    docs.done()
    sign = codes[[langs.index(t) for t in targets]] if langs else codes
    rng = np.random.Generator(np.random.PCG64(2))
    step, steps = 0, max(1, EPOCHS * len(docs))
    for _ in range(EPOCHS if len(langs) > 1 else 0):
        for i in rng.permutation(len(docs)):
            ids, share = docs[i]
            rate = RATE * (1 - step / steps)
            step += 1
            y = sign[i]
            pull = (y * learn.sigmoid(-y * (share @ weight[ids] + bias))).astype(np.float32)
            weight[ids] += rate * np.outer(share, pull)
            bias += np.float32(0.01 * rate) * pull
    return Model(langs, codes, weight, bias)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> Model:
    """Fit on documents whose language is given."""
    rows = (docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("target")))
    sample = learn.with_text(learn.sample_ids(rows, per_language), docs, id_col, text_col)
    return learn.train(sample.withColumn("text", F.lower("text")), fit)


def identify(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with lang_pred, score (0 to 1) and ambiguous (columns of these names
    are replaced).

    Edge cases: a null text, one without any letter, and every text when training
    saw no language get ``und``, score 0 and are ambiguous; repeated rows get
    equal results; an empty table stays empty.
    """
    text_batches(df.sparkSession)
    made = ("lang_pred", "score", "ambiguous")
    keep = [c for c in df.columns if c not in made]
    sent = df.sparkSession.sparkContext.broadcast(model)  # 2**BITS rows of a few numbers
    lower, letters = free_names(df, "lower_text", "has_letters")
    prepared = df.select(*[f"`{c}`" for c in keep], F.lower(text_col).alias(lower),
                         F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias(letters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        langs = np.array([*m.langs, "und"], object)
        for b in batches:
            known = b.column(len(keep) + 1).to_numpy(zero_copy_only=False).astype(bool) & bool(m.langs)
            if m.langs:
                best, p, gap = m.decode(m.margins(b.column(len(keep))))
            else:
                best = p = gap = np.zeros(b.num_rows)
            best = np.where(known, best, len(m.langs)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(keep)], pa.array(langs[best], pa.string()), pa.array(np.where(known, p, 0.0)),
                 pa.array(~known | (gap < AMBIGUOUS_BELOW))], names=[*keep, *made])

    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep),
                        "lang_pred string, score double, ambiguous boolean"])
    return prepared.mapInArrow(run, schema)

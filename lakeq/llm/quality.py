"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed words, word pairs and
character n-grams; a softmax over that average gives the score. Vectors and
softmax are trained together by numpy stochastic gradient descent on a bounded
sample of labelled documents (``MAX_LABELLED`` per class), each with its whole
text. For scoring, the softmax of two classes over an average is the logistic of
an average of one number per feature, so that table alone goes to executors and
every whole text is scored in one map over the corpus, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeq.llm import learn, textvec
from lakeq.llm.common import text_batches

BITS = 18            # hashed features
DIM = 8              # length of a feature's vector
SIZES = (3, 4, 5)    # characters (bytes) of the n-grams
EPOCHS = 4           # rounds over the sample, more of them for a small one:
MIN_STEPS = 8000     # steps at least
RATE = 1.0           # first step length, falling linearly to 0
MAX_LABELLED = 1500  # documents per class that training sees
KEEP_FROM = 0.3      # score from which a document is predicted good

_SPACE = np.where(textvec.SPACE, 32, np.arange(256)).astype(np.uint8)


def features(data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Buckets of every feature of a slice as (buckets, row offsets, window length)."""
    flat = _SPACE[data]
    for n in SIZES:
        yield textvec.ngrams(flat, n, BITS), offs, n
    start, end = textvec.words(data, offs)
    h = textvec.span_hash(textvec.rolling(data), start, end)
    to = np.concatenate(([0], np.cumsum(np.bincount(textvec.row_of(offs, start), minlength=len(offs) - 1))))
    shift = np.uint64(64 - BITS)
    yield (h >> shift).astype(np.int64), to, 1
    # A pair of equal words is one feature, whatever the word.
    pair = np.where(h[1:] == h[:-1], textvec.MIX[59], textvec.mix(h[1:] * textvec.MIX[0] + h[:-1] * textvec.MIX[1]))
    yield (pair >> shift).astype(np.int64), to, 2


@dataclass
class Model:
    weight: np.ndarray  # by bucket: what the feature adds to the logit
    bias: float

    def score(self, col: pa.Array) -> np.ndarray:
        out = [np.zeros(0)]
        for at, end, data, offs in textvec.slices(col):
            total, n = np.zeros(end - at), np.zeros(end - at)
            for bucket, to, size in features(data, offs):
                total += textvec.row_sums(self.weight[bucket], to, size)
                n += np.maximum(np.diff(to) - size + 1, 0)
            out.append(learn.sigmoid(total / np.maximum(n, 1) + self.bias))
        return np.concatenate(out)


def fit(targets: list, texts: pa.ChunkedArray) -> Model:
    """Stochastic gradient descent, one document a step. Without both classes the
    model scores every text alike."""
    y = np.array(targets, np.int64)
    share = y.mean() if len(y) else 0.5
    if share in (0, 1) or not len(y):
        return Model(np.zeros(1 << BITS, np.float32), float(np.clip(share * 20 - 10, -3, 3)))
    docs = learn.Bags()
    for chunk in texts.chunks:
        for at, end, data, offs in textvec.slices(chunk):
            found = list(features(data, offs))
            for r in range(end - at):
                docs.add(np.concatenate([textvec.row_values(b, to, n, r) for b, to, n in found]))
    docs.done()
    rng = np.random.Generator(np.random.PCG64(1))
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    out, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    epochs = max(EPOCHS, -(-MIN_STEPS // len(docs)))
    step, steps = 0, epochs * len(docs)
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            ids, share_of = docs[i]
            rate = RATE * (1 - step / steps)
            step += 1
            hidden = share_of @ vectors[ids]
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            down = out.T @ p
            out -= rate * np.outer(p, hidden)
            bias -= np.float32(0.1 * rate) * p
            vectors[ids] -= (rate * len(ids) ** 0.5) * np.outer(share_of, down)
    return Model(vectors @ (out[1] - out[0]), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          target_col: str = "quality", max_labelled: int = MAX_LABELLED) -> Model:
    """Fit on labelled documents. A repeated label row counts once; of conflicting
    labels the smaller one holds; labels other than 0 and 1 and null ids are ignored."""
    rows = (labels.where(F.col(target_col).isin(0, 1)).groupBy(F.col(id_col).alias("doc_id"))
            .agg(F.min(target_col).cast("int").alias("target")))
    return learn.train(learn.with_text(learn.sample_ids(rows, max_labelled), docs, id_col, text_col), fit)


def score(df: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``df`` with a ``score`` column (0 to 1, a column of that name is replaced).

    Edge cases: null and empty texts get the score of a text without features;
    repeated rows get equal scores; an empty table stays empty; other columns
    pass through unread.
    """
    text_batches(df.sparkSession)
    keep = [c for c in df.columns if c != out]
    fields = [df.schema[c] for c in keep]
    sent = df.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(keep.index(text_col))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sent.value.score(text), pa.float64())],
                                             names=[*b.schema.names, out])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{out}` double"])
    return df.select(*[f"`{c}`" for c in keep]).mapInArrow(run, schema)

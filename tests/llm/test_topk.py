import math

import numpy as np
import pytest

from lakeq.llm import topk


def test_block_search_equals_sorting_all():
    rng = np.random.default_rng(1)
    for _ in range(150):
        n, d = int(rng.integers(65, 500)), int(rng.choice([1, 3, 16, 64]))
        x = np.floor(rng.normal(size=(n, d)) * rng.choice([1, 5, 40])).astype(np.int64)
        if rng.random() < 0.3:
            x[rng.integers(0, n, n // 2)] = x[0]
        q = x[int(rng.integers(0, n))] if rng.random() < 0.7 else np.floor(rng.normal(size=d) * 20).astype(np.int64)
        own = int(rng.integers(0, n)) if rng.random() < 0.5 else None
        got, score = topk.search_block(x, *topk.index_block(x), q, 5, slice(0, 0) if own is None else slice(own, own + 1))
        rows = np.array([i for i in range(n) if i != own])
        want = rows[np.lexsort((rows, -(x @ q)[rows]))[:5]]
        assert got.tolist() == want.tolist() and score.tolist() == (x @ q)[want].tolist()


def test_rescoring_takes_over_when_it_reads_less_than_the_postings_left():
    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, key):
            out = super().__getitem__(key)
            Counted.read += out.size
            return out
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(8192, 64)) * 32).astype(np.int64)
    order, values = topk.index_block(x)
    for i in range(10):
        got, score = topk.search_block(x, order.view(Counted), values, x[i], 5, slice(i, i + 1))
        rows = np.delete(np.arange(len(x)), i)
        want = rows[np.lexsort((rows, -(x @ x[i])[rows]))[:5]]
        assert got.tolist() == want.tolist() and score.tolist() == (x @ x[i])[want].tolist()
    assert Counted.read < 0.85 * 10 * x.size


@pytest.mark.parametrize("block", [8192, 70])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "CHUNK_QUERIES", 3)
    monkeypatch.setattr(topk, "SLAB_CHUNKS", 2)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, rows[10][1]) for i in range(400, 440)]                       # ties
    rows += [(450, None), (500, [math.nan] * 16), (550, [math.inf] + [0.0] * 15), (600, [None] + [0.0] * 15), (650, []),
             (None, [1.0] * 16), (700, [1.0, 2.0]), (750, [0.5, -1.0]), rows[50], (800, [0.0] * 16),
             (33, [9.0] * 16), (33, rows[34][1]), (100, [2.0] * 16)]              # repeated ids, as candidate and as query
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int").repartition(4)
    got = sorted(map(tuple, topk.top_k(df, df.where("vec_id % 50 = 0")).collect()))
    use = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
           if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, v in use:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in use if i != q and len(w) == len(v))
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:5])]
    assert got == sorted(want)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    one = spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(none, none).collect() == [] and topk.top_k(one, one).collect() == []
    assert topk.top_k(one, none).collect() == []


def test_components_beyond_a_long_are_refused(spark):
    df = spark.createDataFrame([(0, [1e30, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    with pytest.raises(ValueError, match="64-bit"):
        topk.top_k(df, df)

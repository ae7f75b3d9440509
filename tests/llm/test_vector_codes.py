import hashlib

import numpy as np
import pytest

from lakeq.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts, entries, rounds, scale):
    """Codes by comparing every part with every entry, in Python integers."""
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v], label) for i, v, label in rows
            if v and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // parts
    cut = [[v[p * size:(p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(c[p], books[p])[1] for c in cut]
            for e in range(len(books[p])):
                got = [c[p] for c, i in zip(cut, own) if i == e]
                if got:
                    books[p][e] = [sum(x) // len(got) for x in zip(*got)]
    out = []
    for (i, _, label), c in zip(kept, cut):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label))
    text = ",".join(str(x) for b in books for e in b for x in e)
    total = {}
    for _, _, error, label in out:
        total[label] = total.get(label, 0) + error
    return sorted(((i, code, error, total[label], hashlib.sha256(text.encode()).hexdigest())
                   for i, code, error, label in out), key=str)


@pytest.mark.parametrize("entries", [1, 7, 16, 100])
def test_codes_equal_plain_codes(spark, entries):
    rng = np.random.default_rng(entries)
    centres = rng.normal(size=(9, 8))
    rows = [(int(i), (centres[i % 9] + rng.normal(scale=0.05, size=8)).round(2).tolist(), int(i % 3) if i % 7 else None)
            for i in rng.permutation(150)]
    rows += [(3, rows[0][1], 1), (3, rows[0][1], 1), (None, rows[1][1], 2), (200, None, 1), (201, [], 1),
             (202, [1.0, None] * 4, 1), (203, [float("nan")] * 8, 1), (204, [float("inf")] + [0.0] * 7, 1),
             (205, [0.0] * 8, 0), (206, [-0.0] * 8, 0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS code", "2 AS key", "3 AS v").repartition(3)
    got = vector_codes.compress(df, parts=4, entries=entries, rounds=3, scale=64)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, 4, entries, 3, 64)


def test_candidates_are_few_and_hold_every_tie():
    rng = np.random.default_rng(1)
    points = rng.integers(-500, 500, (200, 6))
    points[150] = points[3]
    x = np.concatenate([points + rng.integers(-2, 3, points.shape), rng.integers(-500, 500, (100, 6))])
    index = vector_codes.Slices(points)
    distance = ((x[:, None, :] - points[None]) ** 2).sum(axis=2)
    entry, least = index.nearest(x)
    assert (least == distance.min(axis=1)).all() and (entry == distance.argmin(axis=1)).all()
    bits = np.unpackbits(index.candidates(x).view(np.uint8), axis=1, bitorder="little")[:, :200].astype(bool)
    assert bits[distance == least[:, None]].all() and bits.sum() < 0.4 * bits.size


def test_decoded_vectors_are_near(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist(), 0) for i in range(300)]
    scratch = vector_codes.Scratch(spark, "t")
    integers = vector_codes.integer_vectors(spark.createDataFrame(rows, SCHEMA), scratch, 4, 256, "vec_id", "embedding", "label")
    books = vector_codes.fit(integers, 4, 64, 4, 256)
    coded = {r.vec_id: vector_codes.decode(r.code, books) for r in vector_codes.encode(integers, books).collect()}
    off = [np.linalg.norm(np.array(coded[i]) - v) / np.linalg.norm(v) for i, v, _ in rows]
    assert np.mean(off) < 0.35


def test_empty_and_impossible_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    got = vector_codes.compress(empty)
    assert got.collect() == [] and got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    for rows, says in (([(1, [1.0] * 8, 0), (2, [1.0] * 16, 0)], "different lengths"),
                       ([(1, [1.0] * 9, 0)], "equal parts"), ([(1, [1e30] * 8, 0)], "64-bit")):
        with pytest.raises(ValueError, match=says):
            vector_codes.compress(spark.createDataFrame(rows, SCHEMA))

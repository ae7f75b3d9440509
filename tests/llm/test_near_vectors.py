import math
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

from lakeq.llm import near_vectors
from tests.llm import brute


def unit(v):
    v = np.array(np.array(v, np.float32), float)
    v = v / np.abs(v).max()
    return v / np.sqrt(v @ v)


@pytest.mark.parametrize("cell,tile", [(30, 25), (4096, 4096)])
def test_equals_all_pairs(spark, monkeypatch, cell, tile):
    monkeypatch.setattr(near_vectors, "CELL_ROWS", cell)
    monkeypatch.setattr(near_vectors, "TILE_ROWS", tile)
    rng = np.random.default_rng(cell)
    base = rng.normal(size=(12, 8))
    rows = []
    for i in range(300):
        v = (base[rng.integers(12)] + rng.normal(size=8) * rng.choice([0, 0.2, 0.35, 0.6])).astype(np.float32).tolist()
        rows.append((i, v, int(rng.integers(0, 2)) if rng.random() > 0.05 else None))
    rows += [(i, rows[0][1], 0) for i in range(500, 620)]  # a large group of equal vectors
    rows += [(1000, None, 1), (1001, [0.0] * 8, 1), (1002, [math.nan] * 8, 1), (1003, [1.0, None] + [0.0] * 6, 0),
             (1004, [], 0), (1005, [1.0, 2.0], 0), (1006, [1e-30] * 8, 0), (1007, [3e38] * 8, 0), rows[1]]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, cell string")
    got = sorted(map(tuple, near_vectors.near_vectors(df.repartition(5)).collect()))
    use = [r[2] is not None and bool(r[1]) and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])
           for r in rows]
    units = [unit(r[1]) if u else None for r, u in zip(rows, use)]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a)
             if use[a] and use[b] and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b])
             and units[a] @ units[b] >= 0.93]
    comp = brute.groups(len(rows), pairs)
    degree, least = [0] * len(rows), {}
    for a, b in pairs:
        degree[a] += 1
        degree[b] += 1
    for r, c in zip(rows, comp):
        least[c] = min(least.get(c, r[0]), r[0])
    assert got == sorted((r[0], d, least[c], r[0] == least[c]) for r, d, c in zip(rows, degree, comp))


def test_boundary_copies_cover_all_partners():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 6))
    x = np.concatenate((x, x + rng.normal(size=x.shape) * 0.15))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    home, near = near_vectors.cells_of(x, x[:9], math.sqrt(2 - 2 * 0.93))
    a, b = np.nonzero(x @ x.T >= 0.93)
    assert near[b, home[a]].all() and not near.all()


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert near_vectors.near_vectors(df).collect() == []


def test_different_vectors_of_one_id_link(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [1.0, 0.1], 0), (2, [1.0, 0.05], 0), (3, [0.0, 1.0], 0), (3, [0.0, 1.0], 0)],
                               "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, near_vectors.near_vectors(df).collect()))
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 3, True), (3, 1, 3, True)]


def by_pairs(x, label):
    """(n_links, component) of every row, where all rows are distinct; components by least row."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (x @ x.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(linked, False)
    least = np.arange(len(x))
    while ((after := np.minimum(least, np.where(linked, least, len(x)).min(1))) != least).any():
        least = after
    return linked.sum(1).tolist(), least.tolist()


def shuffle_files(spark):
    """Bytes of each file of shuffled rows that there is now."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = [Path(f.toString()) for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles())]
    return {f: f.stat().st_size for f in files if f.name.startswith("shuffle_") and f.exists()}


def test_vectors_are_shuffled_and_written_once_whatever_they_are_near(spark, monkeypatch):
    """Vectors without clusters are near all cells; with a copy for each this took 62 times their bytes."""
    monkeypatch.setattr(near_vectors, "CELL_ROWS", 100)
    monkeypatch.setattr(near_vectors, "TILE_ROWS", 500)
    written, shuffled, table = [], {}, near_vectors.Scratch.table

    def weighed(self, *args, **more):
        out = table(self, *args, **more)
        shuffled.update(shuffle_files(spark))
        folder = Path(out._scratch_path.removeprefix("file:"))
        written.append(sum(p.stat().st_size for p in folder.rglob("*.parquet")))
        return out

    monkeypatch.setattr(near_vectors.Scratch, "table", weighed)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 32)).astype(np.float32)
    x[1000:1100] = x[:100] + rng.normal(size=(100, 32)).astype(np.float32) * 0.1
    df = spark.createDataFrame(pd.DataFrame({"vec_id": range(4000), "embedding": x.tolist(), "label": 0}),
                               "vec_id long, embedding array<float>, label int")
    df = df.repartition(4).cache()
    df.count()
    before = shuffle_files(spark)
    got = near_vectors.near_vectors(df).orderBy("vec_id").collect()
    df.unpersist()
    degree, least = by_pairs(x.astype(float), np.zeros(4000))
    assert ([r.n_links for r in got], [r.component_id for r in got]) == (degree, least) and sum(degree) > 100
    assert sum(n for f, n in shuffled.items() if f not in before) + sum(written) < 8 * x.nbytes


@pytest.mark.parametrize("kind", ["float", "double"])
def test_large_clusters_in_several_tiles(spark, monkeypatch, kind):
    """Blocks of many links, chains across tiles, and copies of clustered vectors."""
    monkeypatch.setattr(near_vectors, "CELL_ROWS", 900)
    monkeypatch.setattr(near_vectors, "TILE_ROWS", 400)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(4, 40))
    x = np.concatenate([c + rng.normal(size=(450, 40)) * s for c, s in zip(centres, (0.1, 0.2, 0.27, 0.5))])
    x = x.astype(np.float32 if kind == "float" else float)
    label = (np.arange(len(x)) % 5 == 0).astype(int)
    assert (label == 0).sum() > 1200
    ids, degree, least = np.arange(len(x)), *by_pairs(x.astype(float), label)
    twice = np.arange(0, 1800, 6)  # these rows come again, as ids from 10000
    times, unit_x = np.ones(len(x), int), x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    times[twice] += 1
    linked = (unit_x @ unit_x.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(linked, False)
    links = linked @ times + times - 1
    rows = [(int(i), x[i].tolist(), int(label[i])) for i in ids] + [(10_000 + int(i), x[i].tolist(), int(label[i])) for i in twice]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    got = sorted(map(tuple, near_vectors.near_vectors(df.repartition(3)).collect()))
    assert got == [(r, links[r % 10_000], least[r % 10_000], r == least[r % 10_000]) for r, _, _ in rows]
    assert max(degree) > 300


def test_a_filter_bounds_the_cosine_and_an_order_keeps_all_rows():
    rng = np.random.default_rng(3)
    x = near_vectors._unit(rng.normal(size=(700, 50)) + 1)
    for basis in (None, near_vectors.directions(x[:60])):
        f = near_vectors.filter_of(x, basis)
        assert f.shape == (700, near_vectors.FILTER) and (f @ f.T >= x @ x.T - 1e-6).all()
    order = near_vectors.coherent(f, 64)
    assert sorted(order) == list(range(700))
    low, high = near_vectors.boxes(f[order], 64)
    assert len(low) == 11 and (low <= high).all() and np.prod(high - low, 1, dtype=float).mean() < np.prod(np.ptp(f, axis=0), dtype=float)

"""Embedding near-dedup: an exact metric range join over tiles of pivot cells.

Vectors are compared within a group (equal label, equal length) by cosine. For
unit vectors a cosine of at least t is a distance of at most r = sqrt(2 - 2t), a
metric range join. In a large group, pivots partition the vectors: each belongs
to the cell of its nearest pivot and is near every cell whose boundary is within r
of it. By the triangle inequality a partner in cell j of a vector at home in cell h
needs (d_j - d_h) / 2 <= r, and in Euclidean space also
(d_j**2 - d_h**2) / (2 |p_j - p_h|) <= r, the distance to the boundary plane.

A vector is shuffled and written once, whatever it is near to: cells are cut into
tiles of TILE_ROWS, each one row with all that comparing it takes. A tile is joined
with itself as it is made. Pairs of tiles of one group meet in a Cartesian product
that reads the written tiles again and shuffles nothing; of a pair, only the vectors
near the other's cell are compared, and pairs without any are left out.

Two vectors are compared on FILTER numbers first: the parts along a few directions
and the length of the rest, whose product is an upper bound of the cosine (Cauchy
and Schwarz). What passes is computed in full. Equal vectors are one class with a
multiplicity. In a tile similar vectors stand together (a k-d tree's order), so that blocks too far
apart are skipped and those with many links multiplied in full. A task returns, per
vector, a number of links and one edge to its local component, never its pairs.

Pivots go to every task; there are at most MAX_GROUPS * MAX_PIVOTS of them.
Groups without pivots are one cell.
"""

from __future__ import annotations

import math
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import FloatType

from lakeq.llm.common import Scratch
from lakeq.llm.components import components

CELL_ROWS = 16384      # rows a cell should hold
MAX_GROUPS = 128       # largest groups that get pivots
MAX_PIVOTS = 64        # of one group; a bit of a long each
TILE_ROWS = 16384      # of a tile
TILE_BYTES = 1 << 24   # of a tile's vectors in doubles
WAVE_ROWS = 1 << 18    # groups are joined together up to so many rows
FILTER = 24            # numbers that a pair is compared on first
BLOCK = (1024, 256)    # pairs compared at once
SLACK = 1e-9           # on distances, for rounding: neighbours too many, never too few

# While tiles are joined: two to a batch, and 16 MB of either side to a task.
WAVE_SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1", "spark.sql.files.maxPartitionBytes": "16m",
                 "spark.sql.files.minPartitionNum": "1"}

# Columns of a tile.
TILE = {"gid": pa.int32(), "cell": pa.int32(), "tile": pa.int64(), "odd": pa.int32(), "dim": pa.int32(), "mask": pa.int64(),
        **{name: pa.binary() for name in ("classes", "copies", "near", "filters", "vectors")}}


def usable(col: str) -> Column:
    """A vector that is not null, not all zero and has only finite components."""
    return (F.col(col).isNotNull() & F.forall(col, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
            & F.exists(col, lambda x: x != 0))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow or underflow in the norm
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cells_of(x: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit vector, and rows x cells it is near."""
    d2 = np.maximum(2 - 2 * x @ pivots.T, 0)
    home = d2.argmin(1)
    apart = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))
    rows = np.arange(len(x))
    nearest = d2[rows, home][:, None]
    d = np.sqrt(d2)
    near = (d - np.sqrt(nearest)) / 2 <= radius + SLACK
    near &= d2 - nearest <= 2 * apart[home] * (radius + SLACK) + SLACK
    near[rows, home] = True
    return home, near


def directions(sample: np.ndarray) -> np.ndarray:
    """Orthonormal columns, at most FILTER - 1, along which unit vectors like these differ most."""
    return np.linalg.eigh(sample.T @ sample)[1][:, ::-1][:, :FILTER - 1]


def filter_of(x: np.ndarray, basis: np.ndarray | None) -> np.ndarray:
    """Of unit vectors: the parts along the basis (without one: the first), and the length of the rest."""
    part = x[:, :FILTER - 1] if basis is None else x @ basis
    rest = np.sqrt(np.maximum(1 - (part * part).sum(1), 0))
    return np.ascontiguousarray(np.column_stack((part, rest)), np.float32)


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the components of the nodes a[i] and b[i] one label, their least."""
    while True:
        x, y = label[a], label[b]
        if (apart := x != y).any():
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        else:
            return
        least = np.minimum(x, y)
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        while (next_label := label[label]).tobytes() != label.tobytes():
            label[:] = next_label


def coherent(f: np.ndarray, rows: int) -> np.ndarray:
    """An order in which the first, second, ... ``rows`` rows are the leaves of a k-d tree."""
    order, todo = np.arange(len(f)), [(0, len(f))]
    while todo:
        lo, hi = todo.pop()
        if (leaves := -(-(hi - lo) // rows)) > 1:
            mid = lo + leaves // 2 * rows
            part = f[order[lo:hi]]
            order[lo:hi] = order[lo:hi][np.argpartition(part[:, part.var(0).argmax()], mid - lo)]
            todo += [(lo, mid), (mid, hi)]
    return order


def boxes(f: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest numbers of each ``rows`` rows."""
    at = np.arange(0, len(f), rows)
    return np.minimum.reduceat(f, at), np.maximum.reduceat(f, at)


class Links:
    """Numbers of links and components of the classes of some tiles."""

    def __init__(self, threshold: float):
        self.threshold, self.first = threshold, {}
        self.classes, self.links, self.label = (np.zeros(0, np.int64) for _ in range(3))

    def nodes(self, tile: int, classes: np.ndarray) -> int:
        """Number of the first class of the tile here."""
        if tile not in self.first:
            at = self.first[tile] = len(self.label)
            self.classes = np.concatenate((self.classes, classes))
            self.links = np.concatenate((self.links, np.zeros(len(classes), np.int64)))
            self.label = np.concatenate((self.label, np.arange(at, at + len(classes))))
        return self.first[tile]

    def join(self, a: tuple, b: tuple | None = None) -> None:
        """Link the rows of a with those of b, or with each other. Each is the nodes, their copies,
        filters and vectors."""
        self.a, self.b, self.floats = a, b or a, {}
        (x, y), waiting, n = (self.a[2], self.b[2]), [], 0
        if not (len(x) and len(y)):
            return
        self.error = (self.a[3].shape[1] + 8) * 2.0 ** -23  # of products of unit vectors in floats
        least = np.float32(self.threshold - self.error)
        (low, high), (least_y, most_y) = boxes(x, BLOCK[0]), boxes(y, BLOCK[1])
        for k, j in enumerate(range(0, len(y), BLOCK[1])):
            turned = np.ascontiguousarray(y[j:j + BLOCK[1]].T)
            gap = np.maximum(np.maximum(low - most_y[k], least_y[k] - high), 0)
            for i in (np.flatnonzero((gap * gap).sum(1) <= 2 - 2 * least) * BLOCK[0]).tolist():
                if not b and i >= j + BLOCK[1]:
                    break
                product = x[i:i + BLOCK[0]] @ turned
                if product.max() < least:
                    continue
                passed = product >= least
                if not b and i + BLOCK[0] > j:
                    passed &= np.arange(i, i + len(product))[:, None] < np.arange(j, j + product.shape[1])
                rows, cols = np.divmod(np.flatnonzero(passed), passed.shape[1])
                if len(rows) > 1024:
                    some = np.flatnonzero(passed.any(1)), np.flatnonzero(passed.any(0))
                    if 16 * len(rows) > len(some[0]) * len(some[1]):
                        self._dense(passed, *some, i, j)
                        continue
                waiting.append((rows + i, cols + j))
                n += len(rows)
                if n > 1 << 16:
                    self._pairs(*map(np.concatenate, zip(*waiting)))
                    waiting, n = [], 0
        if n:
            self._pairs(*map(np.concatenate, zip(*waiting)))

    def _true(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        out = [np.einsum("ij,ij->i", _unit(self.a[3][rows[k:k + 4096]]), _unit(self.b[3][cols[k:k + 4096]])) >= self.threshold
               for k in range(0, len(rows), 4096)]
        return np.concatenate(out) if out else np.zeros(0, bool)

    def _pairs(self, rows: np.ndarray, cols: np.ndarray) -> None:
        true = self._true(rows, cols)
        rows, cols = rows[true], cols[true]
        np.add.at(self.links, self.a[0][rows], self.b[1][cols])
        np.add.at(self.links, self.b[0][cols], self.a[1][rows])
        unite(self.label, self.a[0][rows], self.b[0][cols])

    def _units(self, side: str, rows: np.ndarray) -> np.ndarray:
        if side not in self.floats:
            vectors = getattr(self, side)[3]
            self.floats[side] = np.concatenate([_unit(vectors[k:k + 4096]).astype(np.float32) for k in range(0, len(vectors), 4096)])
        return self.floats[side][rows]

    def _dense(self, passed: np.ndarray, rows: np.ndarray, cols: np.ndarray, i: int, j: int) -> None:
        """Where many pairs of a block pass, it is multiplied, and only what rounding could change is
        computed by pair."""
        passed, rows, cols = passed[np.ix_(rows, cols)], rows + i, cols + j
        product = self._units("a", rows) @ self._units("b", cols).T
        product -= np.float32(self.threshold)
        linked = product >= 0
        close = np.nonzero(np.abs(product, out=product) <= self.error)
        linked[close] = self._true(rows[close[0]], cols[close[1]])
        linked &= passed
        own, others, times = self.a[0][rows], self.b[0][cols], linked.astype(np.float64)
        self.links[own] += (times @ self.b[1][cols].astype(np.float64)).astype(np.int64)
        self.links[others] += (self.a[1][rows].astype(np.float64) @ times).astype(np.int64)
        one, other = self.label[own], self.label[others]
        if min(one.min(), other.min()) < max(one.max(), other.max()):
            r, c = np.nonzero(linked & (one[:, None] != other))
            size = len(self.label)  # one pair of each two labels is enough
            two = np.unique(one[r] * size + other[c])
            unite(self.label, two // size, two % size)

    def found(self) -> pa.Table:
        at = np.flatnonzero((self.links > 0) | (self.label != np.arange(len(self.label))))
        return pa.table({"class": pa.array(self.classes[at], pa.int64()), "links": pa.array(self.links[at], pa.int64()),
                         "root": pa.array(self.classes[self.label[at]], pa.int64())})


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    """Settings for the jobs run inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _waves(sizes: list[int]) -> list[int]:
    """Number of the wave of each group: groups of up to WAVE_ROWS in all, or one larger one."""
    out, wave, held = [], 0, 0
    for n in sizes:
        if held and held + n > WAVE_ROWS:
            wave, held = wave + 1, 0
        held += n
        out.append(wave)
    return out


def near_vectors(df: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                 group_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Edge cases: vectors that are null, empty, zero or hold null or non-finite
    components, and rows without a group or id, have no links and are their own
    component; repeated rows are vectors of their own that link with each other;
    vectors of different lengths are not compared; other columns are not read; an
    empty table gives an empty result.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "vectors")
    radius = math.sqrt(2 - 2 * threshold)
    takes_part = usable(vector_col) & F.col(group_col).isNotNull() & F.col(id_col).isNotNull()
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(group_col).alias("grp"), F.col(vector_col).alias("vector"),
                     takes_part.alias("in"))
    same = [F.xxhash64("grp", "vector").alias("h1"), F.xxhash64(F.lit(7), "vector", "grp").alias("h2")]
    used = rows.where("in").select("grp", F.size("vector").alias("dim"), *same, "vector")
    number = np.dtype(np.float32 if isinstance(df.schema[vector_col].dataType.elementType, FloatType) else np.float64)

    # Groups of several tiles, the largest first; pivots are the first vectors of theirs in hash order.
    tile_rows = F.least(F.lit(TILE_ROWS), F.ceil(F.lit(TILE_BYTES) / (8 * F.col("dim"))))
    sizes = used.groupBy("grp", "dim").agg(F.count("*").alias("n")).withColumn("tile_rows", tile_rows)
    large = scratch.table(sizes.where(F.col("n") > F.col("tile_rows")).orderBy(F.desc("n"), "grp", "dim"), "large")
    groups = large.orderBy(F.desc("n"), "grp", "dim").toArrow().to_pylist()
    gid = {(g["grp"], g["dim"]): i for i, g in enumerate(groups)}
    wave = _waves([g["n"] for g in groups])
    largest = large.where(F.col("n") > CELL_ROWS).orderBy(F.desc("n"), "grp", "dim").limit(MAX_GROUPS)
    wanted = F.least(F.lit(MAX_PIVOTS), F.ceil(F.col("n") / CELL_ROWS))
    drawn = (used.join(F.broadcast(largest), ["grp", "dim"])  # at most MAX_GROUPS rows
             .where(F.col("h1") / 2.0 ** 64 + 0.5 < 8 * wanted / F.col("n")).dropDuplicates(["grp", "dim", "h1", "h2"])
             .withColumn("r", F.row_number().over(W.partitionBy("grp", "dim").orderBy("h1", "h2")))
             .where(F.col("r") <= F.least(F.lit(MAX_PIVOTS), 4 * wanted))
             .select("grp", "dim", "vector", (F.col("r") <= wanted).alias("pivot"), "r"))
    pivots, bases = {}, {}
    if groups:
        drawn = drawn.orderBy("grp", "dim", "r").toArrow()
        which = np.array([gid[key] for key in zip(drawn["grp"].to_pylist(), drawn["dim"].to_pylist())])
        for g in np.unique(which):
            own = drawn.take(np.flatnonzero(which == g))
            units = _unit(own["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1))
            pivots[int(g)], bases[int(g)] = units[own["pivot"].to_numpy()], directions(units)
    sent = spark.sparkContext.broadcast((gid, pivots, bases))

    def placed(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group number (-1: of one tile), cell and near cells of the rows."""
        numbers, centres, _ = sent.value
        group, cell, near = np.full(b.num_rows, -1), np.zeros(b.num_rows, np.int32), np.ones(b.num_rows, np.uint64)
        dims, coded = b["dim"].to_numpy(), b["grp"].dictionary_encode()
        keys, which = np.unique(np.column_stack((coded.indices.to_numpy(), dims)), axis=0, return_inverse=True)
        names, order = coded.dictionary.to_pylist(), np.argsort(which.ravel(), kind="stable")
        for (code, dim), at in zip(keys.tolist(), np.split(order, np.cumsum(np.bincount(which.ravel()))[:-1])):
            if (g := numbers.get((names[code], dim), -1)) < 0:
                continue
            group[at] = g
            if g in centres:
                vectors = b["vector"].take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
                cell[at], close = cells_of(_unit(vectors.reshape(len(at), dim)), centres[g], radius)
                near[at] = (close * (np.uint64(1) << np.arange(close.shape[1], dtype=np.uint64))).sum(1, dtype=np.uint64)
        return group, cell, near

    def count(batches):
        for b in batches:
            group, cell, _ = placed(b)
            keys, n = np.unique(np.column_stack((group, cell))[group >= 0], axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys[:, 0], keys[:, 1], n)], names=["gid", "cell", "n"])

    held = used.mapInArrow(count, "gid long, cell long, n long").groupBy("gid", "cell").agg(F.sum("n").alias("n"))
    held = held.toArrow().to_pylist() if groups else []
    tiles_of = np.ones((len(groups) + 1, MAX_PIVOTS), np.int64)  # the last line is for group -1
    for c in held:
        tiles_of[c["gid"], c["cell"]] = -(-c["n"] // groups[c["gid"]]["tile_rows"])
    tiles_of = spark.sparkContext.broadcast(tiles_of)
    group_type = rows.schema["grp"].dataType.simpleString()

    def assign(batches):
        """The distinct vectors of each batch, with their tiles."""
        for b in batches:
            h1, h2 = b["h1"].to_numpy(), b["h2"].to_numpy()
            _, at, copies = np.unique(np.column_stack((h1, h2)), axis=0, return_index=True, return_counts=True)
            b = b.take(pa.array(at))
            group, cell, near = placed(b)
            bucket = (h2[at].view(np.uint64) % tiles_of.value[group, cell].astype(np.uint64)).astype(np.int32)
            vectors = b["vector"].flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(b["dim"].to_numpy(), dtype=np.int64))) * number.itemsize
            packed = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(
                np.ascontiguousarray(vectors, number))])
            yield pa.RecordBatch.from_arrays(
                [b["grp"], b["dim"], pa.array(group, pa.int32()), pa.array(cell, pa.int32()), pa.array(bucket, pa.int32()),
                 pa.array(near.view(np.int64)), b["h1"], b["h2"], pa.array(copies, pa.int64()), packed],
                names=["grp", "dim", "gid", "cell", "bucket", "near", "h1", "h2", "copies", "vector"])

    made = [0]  # classes that the task has numbered

    def pack(t: pa.Table) -> pa.Table:
        """The classes of a tile with their links in it; for a group of several tiles also the tile."""
        h1, h2, copies = (t[c].to_numpy() for c in ("h1", "h2", "copies"))
        _, at, which = np.unique(np.column_stack((h1, h2)), axis=0, return_index=True, return_inverse=True)
        n, dim, g = len(at), t["dim"][0].as_py(), t["gid"][0].as_py()
        total = np.zeros(n, np.int64)
        np.add.at(total, which.ravel(), copies)
        vectors = np.frombuffer(b"".join(t["vector"].to_pylist()), number).reshape(len(h1), dim)[at]
        first = (TaskContext.get().partitionId() << 33) + made[0]
        made[0] += n
        classes = np.arange(first, first + n)
        filters = np.concatenate([filter_of(_unit(vectors[k:k + 4096]), sent.value[2].get(g)) for k in range(0, n, 4096)])
        order = coherent(filters, min(BLOCK))
        at, total, vectors, filters = at[order], total[order], vectors[order], filters[order]
        links = Links(threshold)
        links.nodes(first, classes)
        links.join((np.arange(n), total, filters, vectors))
        near = t["near"].to_numpy()[at]
        out = {"h1": h1[at], "h2": h2[at], "class": classes, "links": links.links, "root": links.classes[links.label]}
        tile = {"gid": g, "cell": t["cell"][0].as_py(), "tile": first, "odd": int(h1[at[0]] & 1), "dim": dim,
                "mask": int(np.bitwise_or.reduce(near)), "classes": classes.tobytes(), "copies": total.tobytes(),
                "near": near.tobytes(), "filters": filters.tobytes(), "vectors": vectors.tobytes()} if g >= 0 else {}
        more = pa.nulls(bool(tile), pa.int64())
        out = {k: pa.chunked_array([pa.array(v, pa.int64()), more]) for k, v in out.items()}
        for name, kind in TILE.items():
            out[name] = pa.chunked_array([pa.nulls(n, kind), pa.array([tile.get(name)] * bool(tile), kind)])
        return pa.table(out | {"wave": pa.array([wave[g] if g >= 0 else -1] * (n + bool(tile)), pa.int32())})

    kinds = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
    tile_columns = ", ".join(f"`{name}` {kinds[kind]}" for name, kind in TILE.items())
    packed = scratch.table(
        used.mapInArrow(assign, f"grp {group_type}, dim int, gid int, cell int, bucket int, near long, h1 long, h2 long, "
                                "copies long, vector binary")
        .groupBy("grp", "dim", "gid", "cell", "bucket").applyInArrow(
            pack, f"h1 long, h2 long, class long, links long, root long, {tile_columns}, wave int"), "tiles", by="wave")

    def join_tiles(batches):
        """Links between the tiles of all pairs that the task gets."""
        links = Links(threshold)
        for b in batches:
            for row in range(b.num_rows):
                sides, cells = [], [b["l_cell"][row].as_py(), b["r_cell"][row].as_py()]
                for side, other in (("l", cells[1]), ("r", cells[0])):
                    read = lambda c, kind, s=side: np.frombuffer(b[f"{s}_{c}"][row].as_buffer(), kind)  # noqa: E731, B023
                    at = np.flatnonzero((read("near", np.uint64) >> np.uint64(other)) & np.uint64(1))
                    first = links.nodes(b[f"{side}_tile"][row].as_py(), read("classes", np.int64))
                    n, dim = len(read("near", np.uint64)), b[f"{side}_dim"][row].as_py()
                    sides.append((first + at, read("copies", np.int64)[at], read("filters", np.float32).reshape(n, -1)[at],
                                  read("vectors", number).reshape(n, dim)[at]))
                links.join(*sides)
        yield from links.found().to_batches()

    edges = [packed.where("class is not null").select("class", "links", "root")]
    for w in range(max(wave, default=-1) + 1):
        side = spark.read.schema(packed.schema).parquet(f"{packed._scratch_path}/wave={w}").where("tile is not null")
        ours, theirs = (side.select(*[F.col(c).alias(f"{s}_{c}") for c in TILE]) for s in "lr")
        # Each two tiles of a group once, in an order that spreads them over the tasks.
        pairs = ours.join(theirs, F.expr(
            "l_gid <= r_gid AND l_gid >= r_gid AND l_tile <> r_tile AND (l_tile < r_tile) = (l_odd = r_odd) "
            "AND shiftright(l_mask, r_cell) & 1 = 1 AND shiftright(r_mask, l_cell) & 1 = 1"))
        with _settings(spark, WAVE_SETTINGS):
            edges.append(scratch.table(pairs.mapInArrow(join_tiles, "class long, links long, root long"), "found"))
    found = reduce(DataFrame.union, edges)
    part = components(found.where("root <> class").select(F.col("class").alias("u"), F.col("root").alias("v")), scratch)
    classes = rows.where("in").select("vec_id", *same).groupBy("h1", "h2").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    joined = scratch.table(
        classes.join(packed.where("class is not null").select("h1", "h2", "class"), ["h1", "h2"])
        .join(found.where("links > 0").groupBy("class").agg(F.sum("links").alias("links")), "class", "left")
        .join(part.withColumnRenamed("node", "class"), "class", "left").select(
            "h1", "h2", "id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "class").alias("component")), "joined")
    # The least id of a component is aggregated before it is joined back.
    least_of = scratch.table(joined.groupBy("component").agg(F.min("id").alias("component_id")), "least")
    result = scratch.table(joined.join(least_of, "component").select("h1", "h2", "n_links", "component_id"), "result")
    scratch.finish(result)
    thin = rows.select("vec_id", *[F.when(F.col("in"), h).alias(c) for h, c in zip(same, ("h1", "h2"))])
    return thin.join(result, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

"""Exact top-k inner-product search: an impact-ordered score-at-a-time index.

Components are quantised to integers. Rows are dealt into blocks; a block's index
holds, per dimension, its rows ordered by value, so that for any query the
postings of a dimension come in falling order of impact (from the top for a
positive query component, from the bottom for a negative one). An impact is
counted from the least contribution in its dimension, so impacts are never
negative. A query processes the posting segments of all dimensions by falling
impact level; after each level a row has a proven lower and upper score. When
few rows can still be among the k best, or these have fewer components than there
are postings left, that is the proof to stop, and these rows are rescored exactly;
otherwise it goes on, in the end over all postings. No step approximates.

Every query meets every row of its length, so the work is their product; blocks and
slabs bound what a task holds.

Queries meet blocks by an equi-join on (length, block, slab of queries), each
group of bounded size; every block returns its k best rows of a query, and the k
best of those are taken under a rank limit before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeq.llm.common import Scratch

BLOCK_ROWS = 8192
CHUNK_QUERIES = 256    # queries packed into a row
SLAB_CHUNKS = 32       # such rows that meet a block at a time
SCALE = 256
FEW = 64               # possible members at which rescoring takes over
FALL = 16              # ratio of successive impact levels; above the first one bounds tell little


def usable(col: str) -> Column:
    """A vector that is not null and has only finite components."""
    return F.col(col).isNotNull() & F.forall(col, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))


def _vectors(group: pa.Table, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids (rising), row keys and quantised vectors of a group."""
    ids, rows = group["id"].to_numpy().astype(np.int64), group["row"].to_numpy().astype(np.int64)
    flat = group["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(flat * scale).reshape(len(ids), -1).astype(np.int64)
    order = np.lexsort((rows, ids))
    return ids[order], rows[order], x[order]


def index_block(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per dimension, rows in falling order of value, and these values."""
    order = np.argsort(-x.T, axis=1, kind="stable")
    return order, np.take_along_axis(x.T, order, axis=1)


def search_block(x: np.ndarray, order: np.ndarray, values: np.ndarray, q: np.ndarray, k: int,
                 own: slice = slice(0, 0)) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and scores of the k best rows but ``own`` (ties to smaller row numbers)."""
    dims, n = order.shape
    rows = np.arange(n)
    if own.stop > own.start:
        rows = np.delete(rows, own)
    k = min(k, len(rows))
    if not k:
        return rows[:0], rows[:0]
    if n > max(FEW, 2 * k):
        high = np.where(q > 0, q * values[:, 0], q * values[:, -1])
        low = np.where(q > 0, q * values[:, -1], q * values[:, 0])
        span = high - low
        bits = int(dims).bit_length()  # low bits count the dimensions met, the rest adds impacts
        seen, total = np.zeros(n, np.int64), np.full(n, low.sum())
        at = np.zeros(dims, np.int64)
        level = int(span.max())
        while level > 0:
            level = level // FALL
            for d in np.flatnonzero(span >= max(level, 1)):
                # Impacts of at least `level`: values beyond a bound, from one end.
                if q[d] > 0:
                    end = n - int(np.searchsorted(values[d, ::-1], -(-(level + low[d]) // q[d]), "left"))
                    seg = slice(at[d], end)
                else:
                    end = int(np.searchsorted(-values[d], -((level + low[d]) // q[d]), "left"))
                    end = n - end
                    seg = slice(n - end, n - at[d])
                if end > at[d]:
                    seen[order[d, seg]] += values[d, seg] * (q[d] << bits) + (1 - (low[d] << bits))
                    at[d] = end
            total, met = (seen >> bits) + low.sum(), seen & ((1 << bits) - 1)
            wide = span >= max(level, 1)
            upper = total + (wide.sum() - met) * max(level - 1, 0) + span[~wide].sum()
            floor = np.partition(total[rows], len(rows) - k)[len(rows) - k]
            possible = rows[upper[rows] >= floor]
            # rescoring reads fewer numbers than the postings that are left
            if len(possible) <= max(FEW, 2 * k) or len(possible) * dims < n * dims - int(at.sum()):
                rows = possible
                break
        else:
            rows = rows[total[rows] >= np.partition(total[rows], len(rows) - k)[len(rows) - k]]
    score = x[rows] @ q
    best = np.lexsort((rows, -score))[:k]
    return rows[best], score[best]


def top_k(base: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: float = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k rows of ``base`` with the highest
    inner products of quantised components, ``floor(scale * x)``, for every query.

    Edge cases: a query's own id is not among its results; vectors that are null,
    empty or hold null or non-finite components, and rows with a null id, take no
    part; rows that repeat an id are candidates, and queries, of their own; only
    vectors of the query's length are compared; ties go to the smaller id; fewer
    than k candidates give fewer rows; other columns are not read; empty tables give
    an empty result. Components so large that a score (with its counter of
    dimensions) exceeds a long raise ValueError; at 64 dimensions and the scale of
    256 these are components beyond 65,000.
    """
    scratch = Scratch(base.sparkSession, "topk")

    def thin(df: DataFrame) -> DataFrame:
        return df.where(usable(vector_col) & F.col(id_col).isNotNull() & (F.size(vector_col) > 0)).select(
            F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.size(vector_col).alias("dim"),
            F.monotonically_increasing_id().alias("row"))

    def size(df: DataFrame) -> int:
        most = F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double")))))
        n, dim, most = df.agg(F.count("*"), F.max("dim"), most).first()
        if n and (most * scale + 1) ** 2 * dim * 2.0 ** (dim.bit_length() + 1) >= 2.0**62:
            raise ValueError(f"components up to {most:g}: scores would not fit a 64-bit integer")
        return n

    rows, asked = thin(base), thin(queries)
    n, n_queries = size(rows), size(asked)
    blocks, chunks = -(-n // BLOCK_ROWS) or 1, -(-n_queries // CHUNK_QUERIES) or 1
    slabs = -(-chunks // SLAB_CHUNKS)

    def build(group: pa.Table) -> pa.Table:
        ids, _, x = _vectors(group, scale)
        order, values = index_block(x)
        return pa.table({"dim": [x.shape[1]], "block": [group["block"][0].as_py()], "ids": [ids.tobytes()],
                         "vectors": [x.astype(np.int32).tobytes() if np.abs(x).max(initial=0) < 2**31 else x.tobytes()],
                         "order": [order.astype(np.int32).tobytes()],
                         "values": [values.tobytes()]},
                        schema=pa.schema([("dim", pa.int32()), ("block", pa.int32()), *(
                            (c, pa.binary()) for c in ("ids", "vectors", "order", "values"))]))

    def bundle(group: pa.Table) -> pa.Table:
        ids, keys, x = _vectors(group, scale)
        return pa.table({"dim": [x.shape[1]], "slab": [group["chunk"][0].as_py() // SLAB_CHUNKS], "ids": [ids.tobytes()],
                         "rows": [keys.tobytes()], "vectors": [x.tobytes()]},
                        schema=pa.schema([("dim", pa.int32()), ("slab", pa.int32()), *(
                            (c, pa.binary()) for c in ("ids", "rows", "vectors"))]))

    index = scratch.table(
        rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).groupBy("dim", "block")
        .applyInArrow(build, "dim int, block int, ids binary, vectors binary, order binary, values binary"), "index")
    packed = scratch.table(
        asked.withColumn("chunk", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(chunks)).cast("int")).groupBy("dim", "chunk")
        .applyInArrow(bundle, "dim int, slab int, ids binary, rows binary, vectors binary"), "queries")

    def search(block: pa.Table, found: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if block.num_rows and found.num_rows:
            ids = np.frombuffer(block["ids"][0].as_py(), np.int64)
            raw = block["vectors"][0].as_py()
            dims = block["dim"][0].as_py()
            x = np.frombuffer(raw, np.int32 if len(raw) == 4 * len(ids) * dims else np.int64).reshape(-1, dims).astype(np.int64)
            order = np.frombuffer(block["order"][0].as_py(), np.int32).reshape(dims, -1).astype(np.intp)
            values = np.frombuffer(block["values"][0].as_py(), np.int64).reshape(dims, -1)
            for q_ids, q_rows, q_raw in zip(*(found[c].to_pylist() for c in ("ids", "rows", "vectors"))):
                q_ids, q_rows = np.frombuffer(q_ids, np.int64), np.frombuffer(q_rows, np.int64)
                q_raw = np.frombuffer(q_raw, np.int64).reshape(-1, dims)
                first, last = np.searchsorted(ids, q_ids, "left"), np.searchsorted(ids, q_ids, "right")
                for q_id, q_row, q, i, j in zip(q_ids.tolist(), q_rows.tolist(), q_raw, first.tolist(), last.tolist()):
                    best, score = search_block(x, order, values, q, k, slice(i, j))
                    out += zip([q_row] * len(best), [q_id] * len(best), ids[best].tolist(), score.tolist())
        cols = list(zip(*out)) or [()] * 4
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("asked", "query_id", "vec_id", "score"), cols)})

    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = index.withColumn("slab", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1)))).groupBy("dim", "block", "slab")
    right = packed.withColumn("block", every).groupBy("dim", "block", "slab")
    found = scratch.table(left.cogroup(right).applyInArrow(search, "asked long, query_id long, vec_id long, score long"), "found")
    scratch.finish(found)
    best = W.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

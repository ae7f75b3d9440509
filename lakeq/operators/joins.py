"""Joins that stay balanced when one key holds a large share of the rows.

AQE splits a skewed partition only when both join inputs are plain shuffle
stages; a join against an aggregated key set (distinct keys, duplicate-key
counts) is not split. ``split_join`` spreads the rows of hot keys instead:

1. per-key row counts of the big side (combined map-side, so cheap);
2. the keys above ``target_rows`` rows, at most ``MAX_HOT`` of them, with their
   rows of the other side, form a table of fixed size, which is broadcast;
3. rows with a hot key, identical copies and NULL keys included, take their values
   from that table where they are, and their number of the map task becomes a part
   of the join key that no row of the other side has: the shuffle spreads them
   over all tasks, and the shuffle join leaves them alone.

The big side is read twice, once for the counts and once for the join, whether there
are hot keys or not, and every row takes its values from one of the two tables, so the
result equals the plain join. A map task's number is the same when the task is repeated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeq.functions.names import quoted

DEFAULT_TARGET_ROWS = 2_000_000
MAX_HOT = 1000
_N = "__lq_n"
_HIT, _HOT, _TASK, _NO_TASK = "__lq_hit_side", "__lq_hot", "__lq_task", "__lq_no_task"


def key_counts(df: DataFrame, keys) -> DataFrame:
    """(keys..., __lq_n): rows per key, NULL keys included as their own group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N))


def hot_keys(counts: DataFrame, keys, target_rows: int) -> DataFrame:
    """The most frequent keys above ``target_rows`` rows, MAX_HOT at most."""
    return counts.where(F.col(_N) > target_rows).orderBy(F.desc(_N), *keys).limit(MAX_HOT).select(*keys)


def _renamed(df: DataFrame, keys, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{keys.index(c)}") if c in keys else F.col(c) for c in df.columns])


def _equal(left, right):
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def split_join(big: DataFrame, side: DataFrame, keys, how: str = "left", counts: DataFrame | None = None,
               target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """``big`` joined with ``side`` on null-safe equal keys, for how in {left, inner}.

    ``side`` has at most one row per key (leave NULL keys out of it where NULL
    must not match). ``counts`` (keys..., __lq_n) may be passed when the caller
    already has the per-key counts of ``big``."""
    keys = list(keys)
    if how not in ("left", "inner"):
        raise ValueError("split_join supports 'left' and 'inner'")
    payload = [c for c in side.columns if c not in keys]
    s, h = [f"__lq_s{i}" for i in range(len(keys))], [f"__lq_h{i}" for i in range(len(keys))]
    hot = _renamed(hot_keys(counts if counts is not None else key_counts(big, keys), keys, target_rows), keys, "__lq_h")
    side = _renamed(side, keys, "__lq_s").withColumn(_HIT, F.lit(True))
    # MAX_HOT rows at most; a semi-join would move below an aggregated side and read its input once more
    hot_side = side.join(F.broadcast(hot), _equal(s, h)).drop(*h)
    hot_rows = hot.join(F.broadcast(hot_side), _equal(h, s), "left").select(
        *h, F.struct(_HIT, *payload).alias(_HOT))
    rows = [F.col(quoted(c)) for c in big.columns]
    spread = big.join(F.broadcast(hot_rows), _equal(keys, h), "left").select(
        *rows, _HOT, F.when(F.col(_HOT).isNotNull(), F.spark_partition_id() + 1).otherwise(0).alias(_TASK))
    # always 0, but not a constant: a constant would be taken out of the join key. It is never NULL
    # either: a test for NULL would move below the counts, which are shuffled once for all uses
    side = side.withColumn(_NO_TASK, F.hash(*s).bitwiseAND(F.lit(0)))
    joined = spread.join(side, _equal(keys, s) & (F.col(_TASK) == F.col(_NO_TASK)), "left")
    if how == "inner":
        joined = joined.where(F.coalesce(F.col(f"{_HOT}.{_HIT}"), F.col(_HIT), F.lit(False)))
    is_hot = F.col(_HOT).isNotNull()
    return joined.select(*rows, *[
        F.when(is_hot, F.col(_HOT).getField(c)).otherwise(F.col(quoted(c))).alias(c) for c in payload])

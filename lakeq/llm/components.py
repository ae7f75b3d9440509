"""Connected components of a link table by alternating large-star and small-star
rounds, each step written to the shared scratch folder.

A hub's links never meet in one unsplittable task: the least neighbour is a
map-side combined aggregate, and it is written before it is joined back, so both
inputs of that join are plain shuffles that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeq.llm.common import Scratch


def _least(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, least): the least of a node and its neighbours v."""
    return scratch.table(links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least")), "least")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node of ``links`` (u, v); the component is its
    least node. Self links are allowed and keep a lone node in the result."""
    nodes = links.select(F.col("u").alias("node")).union(links.select(F.col("v").alias("node"))).distinct()
    now = scratch.table(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct(), "links")
    seen = None
    while True:
        state = _state(now)
        if state == seen or not state[0]:
            break
        seen = state
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both, scratch)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = scratch.table(large.where("u <> v").distinct(), "large")
        least2 = _least(large, scratch)
        joined = large.join(least2, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("least").alias("v"))
                 .union(least2.select("u", F.col("least").alias("v"))))
        after = scratch.table(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                              .distinct(), "links")
        scratch.drop(now, least, large, least2)
        now = after
    return nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))

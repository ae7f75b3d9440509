"""Mixing sources to target weights by Poisson replication.

Every source gets a mean repetition rate, its share of the character budget over
the characters it holds. A document's number of copies is the inverse Poisson
distribution of that mean at a uniform number hashed from the seed and the
document id, so the draw is repeatable and needs no coordination. Documents are
exploded by their count and dealt out globally by a hash of document and copy.

Two passes: one aggregate over (source, text length), then one shuffle of the
replicated rows. The hot source is not a shuffle key anywhere: the per-source
table is broadcast after its row count has been checked (beyond the bound a
plain join lets AQE split the hot source), and the final shuffle is by a hash of
the copy. Distributions of small means travel with that table; a source so small
that its mean exceeds ``SMALL_MEAN`` is inverted per document in Arrow batches, and
copies are exploded in chunks, so no array grows with a mean.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeq.llm.common import BROADCAST_ROWS, Scratch, free_names

SMALL_MEAN = 200.0  # up to here a distribution is an array of 410 numbers at most, from 0
CHUNK = 1000        # copies that one array holds


def uniform(seed: int, *cols: str) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 of seed and columns."""
    key = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / float(2**52)


def poisson_cdf(mean: float) -> tuple[int, np.ndarray]:
    """(first, P(X <= k) for k = first, first + 1, ...) within 12 standard deviations of
    the mean and 40: below and beyond, the probability is less than double precision."""
    if mean <= 0:
        return 0, np.ones(1)
    spread = 12 * math.sqrt(mean) + 40
    first = max(0, int(mean - spread))
    k = np.arange(first, int(mean + spread) + 1)
    if first == 0:
        log_factorial = np.concatenate(([0.0], np.cumsum(np.log(k[1:]))))
        return 0, np.cumsum(np.exp(k * math.log(mean) - mean - log_factorial))
    # Outward from the mode, so that no large logarithms cancel.
    steps = np.concatenate(([0.0], np.cumsum(np.log(mean / k[1:]))))
    p = np.exp(steps - steps.max())
    return first, np.cumsum(p) / p.sum()


def poisson_count(rate: pd.Series, u: pd.Series) -> pd.Series:
    """The inverse distribution: how many k have P(X <= k) <= u."""
    out = np.zeros(len(rate), np.int64)
    values = rate.to_numpy()
    for mean in np.unique(values[~np.isnan(values)]):
        at = values == mean
        first, cdf = poisson_cdf(float(mean))
        out[at] = first + np.searchsorted(cdf, u.to_numpy()[at], "right")
    return pd.Series(out)


def source_rates(docs: DataFrame, weights: Mapping[str, float], default_weight: float, budget: float,
                 scratch: Scratch) -> DataFrame:
    """One row per source (NULL is a source): characters held and mean copies.

    A source without any characters has no mass to scale; its rows keep a rate of 1.
    """
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else None
    weight = F.coalesce(table[F.col("source")] if weights else F.lit(None).cast("double"), F.lit(float(default_weight)))
    held = scratch.table(
        docs.groupBy("source").agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0)).cast("long").alias("chars"))
        .withColumn("weight", F.when(F.col("chars") > 0, weight).otherwise(F.lit(0.0))), "held")
    total = held.agg(F.sum("chars").alias("chars"), F.sum("weight").alias("weight")).first()
    return held.select("source", "chars", F.when(F.col("chars") == 0, F.lit(1.0)).otherwise(
        F.lit(float(budget * (total["chars"] or 0))) * F.col("weight") / F.lit(float(total["weight"] or 1))
        / F.col("chars")).alias("rate"))


def mix_sources(docs: DataFrame, weights: Mapping[str, float], default_weight: float = 1.0,
                budget: float = 1.0, seed: int = 0, id_col: str = "doc_id",
                made: tuple[str, str] = ("copy", "n_copies")) -> DataFrame:
    """Return every column of ``docs`` plus the number of the copy (from 1) and of
    all copies, named by ``made``, one row per copy, globally shuffled.

    ``weights`` maps a source to its weight in the mix (others, NULL included:
    ``default_weight``); ``budget`` is the size of the mix in multiples of the
    corpus, in characters.

    Edge cases: rows that repeat an id share its draw; a null id draws as the
    text 'null'; null and empty texts count no characters and are copied at
    their source's rate; columns of ``docs`` with the names in ``made`` are replaced;
    an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    rates = source_rates(docs.select("source", "text"), weights, default_weight, budget, scratch)

    source, cdf, rate, u, n, chunk, order = free_names(
        docs, "mix_source", "mix_cdf", "mix_rate", "mix_u", "mix_n", "mix_chunk", "mix_order")

    def with_cdf(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            small = [poisson_cdf(m)[1].tolist() if m <= SMALL_MEAN else None for m in p["rate"]]
            yield pd.DataFrame({source: p["source"], rate: p["rate"], cdf: small})

    table = scratch.table(rates.mapInPandas(with_cdf, f"`{source}` string, `{rate}` double, `{cdf}` array<double>"), "copies")
    scratch.finish(table)
    few = table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    large = table.where(F.col(cdf).isNull()).limit(1).count() > 0
    kept = [f"`{c}`" for c in docs.columns if c not in made]
    joined = docs.select(*kept).join(F.broadcast(table) if few else table, F.col("source").eqNullSafe(F.col(source)))
    count = F.size(F.filter(cdf, lambda c: c <= F.col(u)))
    if large:
        inverse = F.pandas_udf(poisson_count, "long")
        count = F.when(F.col(cdf).isNotNull(), count).otherwise(
            inverse(F.when(F.col(cdf).isNull(), F.col(rate)), F.col(u)))
    counted = joined.withColumn(u, uniform(seed, id_col)).withColumn(n, count.cast("int"))
    chunks = counted.where(F.col(n) > 0).select(
        *kept, n, F.explode(F.sequence(F.lit(0), F.floor((F.col(n) - 1) / CHUNK).cast("int"))).alias(chunk))
    first = F.col(chunk) * CHUNK + 1
    copies = chunks.select(*kept, F.col(n).alias(made[1]), F.explode(
        F.sequence(first, F.least(first + (CHUNK - 1), F.col(n)))).alias(made[0]))
    deal = F.xxhash64(F.lit(seed), F.col(id_col), F.col(f"`{made[0]}`"))
    return (copies.withColumn(order, deal).repartition(order)
            .sortWithinPartitions(order).drop(order))

"""Skew behaviour: one key holding a third of the rows.

Broadcasts are switched off and AQE's skew thresholds lowered so the tiny
fixture behaves like a large table: the hot partition must be split, and the
results must stay exact (checked against DuckDB on the same derivation)."""

import contextlib

import pytest
from pyspark.sql import functions as F

from lakeq.operators import checks, curate, validate
from lakeq.plans.queries import LINEITEM_RULES
from lakeq.plans.tables import load

SF = "/root/testdata/sf0.01"
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _orders(spark):
    return load(spark, SF, "orders").where("o_orderstatus <> 'P'")


def _hot_fact(spark):
    li = load(spark, SF, "lineitem")
    hot = (F.col("l_partkey") % 3) == 0
    return li.select(F.when(hot, F.lit(1)).otherwise(F.col("l_orderkey")).alias("l_orderkey"),
                     "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                     "l_tax")


HOT_SQL = """WITH f AS (
  SELECT CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE l_orderkey END AS l_orderkey, l_linenumber, l_quantity
  FROM lineitem),
d AS (SELECT l_orderkey, l_linenumber FROM f GROUP BY 1, 2 HAVING count(*) > 1)
SELECT (SELECT count(*) FROM f JOIN d USING (l_orderkey, l_linenumber)) AS dup,
       (SELECT count(*) FROM f WHERE NOT EXISTS (
          SELECT 1 FROM orders o WHERE o.o_orderstatus <> 'P' AND o.o_orderkey = f.l_orderkey)) AS unmatched"""


def test_hot_key_validation_is_exact_and_split(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want_dup, want_unmatched = con.execute(HOT_SQL).fetchone()
    with conf(spark, SKEW_CONF):
        tagged = validate.tag_fact(_hot_fact(spark).repartition(8), _orders(spark), LINEITEM_RULES,
                                   target_rows=1000)
        agg = tagged.agg(F.count_if(F.col("__lq_dup_n").isNotNull()).alias("dup"),
                         F.count_if("__lq_unmatched").alias("unmatched"))
        row = agg.collect()[0]
        # the hot key's 20k rows are joined by many tasks, not one
        tasks = tagged.where("l_orderkey = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert (row.dup, row.unmatched) == (want_dup, want_unmatched)
    assert tasks >= 4


def test_hot_key_dimension_and_nullsafe_duplicates(spark):
    with conf(spark, SKEW_CONF):
        fact = _hot_fact(spark).withColumn("l_orderkey", F.when(F.col("l_orderkey") == 1, F.lit(None))
                                           .otherwise(F.col("l_orderkey")))
        ref = load(spark, SF, "orders")
        dim = curate.build_dimension(ref, fact, ref_key="o_orderkey", dim_key="l_orderkey",
                                     fact_key="l_orderkey", inferred_attrs={}, carried={"l_suppkey": "l_suppkey"},
                                     run_id="r", run_ts="2024-07-01 00:00:00")
        assert dim.count() == dim.select("l_orderkey").distinct().count()
        dups = checks.duplicate_key_rows(fact, ["l_orderkey", "l_linenumber"], null_safe=True)
        hot_rows = fact.where("l_orderkey IS NULL").groupBy("l_linenumber").count().where("count > 1")
        expected_hot = hot_rows.agg(F.sum("count")).first()[0]
        assert dups.where("l_orderkey IS NULL").count() == expected_hot


def test_identical_rows_of_a_hot_key_stay_spread(spark):
    """A third of the rows are copies of one row: they never meet in one task."""
    li = load(spark, SF, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey").repartition(8)
    hot = F.col("l_suppkey") % 3 == 0
    fact = li.select(*[F.when(hot, F.lit(7)).otherwise(F.col(c)).cast("long").alias(c) for c in li.columns])
    n = fact.where("l_orderkey = 7 AND l_linenumber = 7").count()
    with conf(spark, SKEW_CONF):
        dups = checks.duplicate_key_rows(fact, ["l_orderkey", "l_linenumber"], target_rows=1000)
        found = dups.where("l_orderkey = 7 AND l_linenumber = 7")
        per_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == n and found.first().dup_count == n
    assert len(per_task) >= 6 and max(per_task) < n / 3


def test_split_join_with_null_keys_and_map_columns(spark):
    from lakeq.operators.joins import split_join
    big = spark.createDataFrame([("k", {"a": i}) for i in range(50)] + [("j", {"b": 1})] + [(None, {"c": 1})] * 30,
                                "k string, m map<string,int>")
    side = spark.createDataFrame([("k", 1)], "k string, v int")
    out = split_join(big, side, ["k"], "left", target_rows=10)
    assert out.count() == 81 and out.where("v = 1").count() == 50 and out.where("k IS NULL AND v IS NULL").count() == 30
    both = split_join(big, spark.createDataFrame([("k", 1), (None, 2)], "k string, v int"), ["k"], "inner", target_rows=10)
    assert both.where("v = 2").count() == 30 and both.count() == 80


def test_tags_equal_counting_by_hand_with_and_without_hot_keys(spark):
    """Copies, NULL keys and unmatched rows; hot reference keys, NULL among them, go another way."""
    from collections import Counter
    rows = [(k, n % 3, 1.0) for k in (1, 2) for n in range(40)] + [(None, n % 2, 1.0) for n in range(30)]
    rows += [(k, None, -1.0) for k in (1, 2, 3)] + [(k, k, 1.0) for k in range(3, 20)] + [(5, 5, 1.0), (None, None, 1.0)]
    fact = spark.createDataFrame(rows, "l_orderkey long, l_linenumber long, l_quantity double").repartition(4)
    ref = spark.createDataFrame([(k,) for k in (2, 4, 5, 5, 6, None)], "o_orderkey long")
    counts = Counter((k, n) for k, n, _ in rows)
    want = Counter()
    for k, n, q in rows:
        copies = counts[k, n] if None not in (k, n) and counts[k, n] > 1 else None
        want[k, n, q, k is None or n is None, copies, q < 0, k not in (2, 4, 5, 6)] += 1
    for target in (10**6, 20, 1):
        tagged = validate.tag_fact(fact, ref, LINEITEM_RULES, target_rows=target)
        assert Counter(tuple(r)[:7] for r in tagged.collect()) == want

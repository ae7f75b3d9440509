"""Properties from the survey's test strategy, over driver tables and generated rows."""


import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from __spark_entry__ import queries
from lakeq.operators import refine, validate
from lakeq.plans.queries import LINEITEM_CONTRACT, LINEITEM_RULES
from lakeq.plans.tables import lineitem_raw, lineitem_staged, orders_reference

SF = "/root/testdata/sf0.001"


def test_refine_is_idempotent(spark):
    once = refine.refine(lineitem_raw(spark, SF), LINEITEM_CONTRACT).df
    twice = refine.refine(once, LINEITEM_CONTRACT).df
    assert once.dtypes == twice.dtypes
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_every_row_is_clean_or_quarantined(spark):
    tf = validate.tag_fact(lineitem_staged(spark, SF), orders_reference(spark, SF), LINEITEM_RULES)
    total = tf.count()
    clean = validate.clean_rows(tf).count()
    gate = validate.gate(validate.counters(tf, validate.tag_reference(orders_reference(spark, SF), LINEITEM_RULES),
                                           LINEITEM_RULES), LINEITEM_RULES).first()
    bad_fact_rows = tf.where(F.col("__lq_missing") | F.col("__lq_dup_n").isNotNull() | F.col("__lq_negative")).count()
    assert clean + bad_fact_rows == total
    assert gate.distinct_bad_rows >= bad_fact_rows


@pytest.mark.parametrize("name", ["validation_summary", "dim_with_inferred", "numeric_summary",
                                  "duplicate_key_rows_nullsafe", "dashboard_join"])
def test_partition_count_does_not_change_results(spark, name):
    def run(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        df = queries()[name](spark, SF)
        return sorted(tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect())
    try:
        assert run(3) == run(11)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-2, 2)), min_size=1, max_size=12))
def test_duplicate_counts_match_brute_force(spark, rows):
    from lakeq.operators import checks
    df = spark.createDataFrame(rows, "k string, v int")
    got = sorted(((r.k, r.v, r.dup_count) for r in checks.duplicate_key_rows(df, ["k"], null_safe=True).collect()), key=repr)
    counts = {}
    for k, _ in rows:
        counts[k] = counts.get(k, 0) + 1
    want = sorted(((k, v, counts[k]) for k, v in rows if counts[k] > 1), key=repr)
    assert got == want

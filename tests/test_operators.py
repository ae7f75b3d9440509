"""Validation, curation, profiling and checks on hand-made edge rows (FIXTURES §4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeq.contracts import ContractError, ValidationRules
from lakeq.operators import checks, curate, profile, serve, validate

RULES = ValidationRules(fact_keys=("provnum", "workdate"), ref_keys=("ccn",), nonnegative=("hrs_a", "hrs_b"),
                        fact_ref_key="provnum", ref_key="ccn")
FACT_SCHEMA = "provnum string, workdate string, hrs_a double, hrs_b double, provname string, county_fips string"


@pytest.fixture()
def fact(spark):
    rows = [
        (None, "20240401", 1.0, 1.0, "n", "f"),        # NULL key twice
        (None, "20240401", 1.0, 1.0, "n", "f"),
        ("015009", "20240402", 1.0, 1.0, "A", "001"),  # duplicate x3, one also negative
        ("015009", "20240402", -1.0, None, "A", "001"),
        ("015009", "20240402", 2.0, 2.0, "A", "001"),
        ("015010", "20240403", None, None, "B", "002"),  # NULL is not negative
        ("015011", "20240404", 0.0, 0.0, "C", "003"),
        ("999999", "20240405", 1.0, 1.0, "Z", "009"),    # not in the reference
    ]
    return spark.createDataFrame(rows, FACT_SCHEMA)


@pytest.fixture()
def ref(spark):
    rows = [("015009", "Prov A", "4"), ("015010", "Prov B", "2"), ("015011", "Prov C", "5"),
            ("111111", "Unused", "3")]
    return spark.createDataFrame(rows, "ccn string, provider_name string, overall_rating string")


def _summary(spark, fact, ref):
    tf, tr = validate.tag_fact(fact, ref, RULES), validate.tag_reference(ref, RULES)
    counters = validate.counters(tf, tr, RULES)
    return {r.metric_name: r.metric_value for r in counters.collect()}, validate.gate(counters, RULES).first()


def test_validation_counters(spark, fact, ref):
    m, gate = _summary(spark, fact, ref)
    assert m["staffing_row_count"] == 8 and m["provider_row_count"] == 4
    assert m["bad_staffing_required_count"] == 2
    assert m["staffing_duplicate_count"] == 3          # NULL keys never duplicate (C2)
    assert m["negative_hours_count"] == 1
    assert m["unmatched_staffing_count"] == 3          # two NULL keys + 999999
    assert m["provider_duplicate_count"] == 0
    # negative + duplicate in one row: counted twice in the critical sum, once as a row
    assert gate.critical_total == 2 + 3 + 1
    assert gate.distinct_bad_rows == 5
    assert gate.passed is False


def test_no_rule_column_raises(spark, fact, ref):
    rules = ValidationRules(fact_keys=("provnum",), ref_keys=("ccn",), nonnegative=("hrs_x",),
                            fact_ref_key="provnum", ref_key="ccn")
    with pytest.raises(ContractError):
        validate.tag_fact(fact, ref, rules)


def test_required_column_gate(spark, fact, ref):
    with pytest.raises(ContractError):
        validate.tag_fact(fact.drop("workdate"), ref, RULES)


def test_quarantine_one_row_per_reason(spark, fact, ref):
    q = validate.quarantine_rows(validate.tag_fact(fact, ref, RULES), "r1", "2024-07-01 00:00:00")
    got = {(r.quarantine_reason): r["count"] for r in q.groupBy("quarantine_reason").count().collect()}
    assert got == {"missing_required_staffing_fields": 2, "duplicate_staffing_keys": 3,
                   "negative_staffing_hours": 1, "unmatched_provider_reference_warning": 3}


def test_null_safe_duplicates(spark, fact):
    assert checks.duplicate_key_rows(fact, ["provnum", "workdate"], null_safe=True).count() == 5
    assert checks.duplicate_key_rows(fact, ["provnum", "workdate"], null_safe=False).count() == 3


def _dim(fact, ref, keep=False):
    return curate.build_dimension(
        ref, fact, ref_key="ccn", dim_key="provnum", fact_key="provnum",
        inferred_attrs={"provname": "provider_name"}, carried={"county_fips": "county_fips"},
        run_id="r1", run_ts=dt.datetime(2024, 7, 1), keep_unreferenced=keep)


def test_dimension_inferred_and_dropped(spark, fact, ref):
    rows = {r.provnum: r for r in _dim(fact, ref).collect()}
    assert "111111" not in rows                        # reference key without fact rows (J4)
    assert rows["999999"].provider_match_status == "inferred_from_staffing"
    assert rows["999999"].provider_reference_gap_flag == "Y"
    assert rows["999999"].provider_name == "Z" and rows["999999"].overall_rating is None
    assert rows["015009"].provider_name == "Prov A" and rows["015009"].county_fips == "001"
    assert rows["015009"].provider_match_status == "matched"
    assert None in rows                                # NULL fact key becomes an inferred row (parity)
    assert "111111" in {r.provnum for r in _dim(fact, ref, keep=True).collect()}


def test_dimension_unique_and_covers_fact(spark, fact, ref):
    dim = _dim(fact, ref)
    assert dim.count() == dim.select("provnum").distinct().count()
    keys = fact.select("provnum").where("provnum is not null").distinct()
    assert keys.join(dim, "provnum", "left_anti").count() == 0


def test_build_fact_and_bad_dates(spark):
    df = spark.createDataFrame([("p", d) for d in ["20240401", "20241301", "20240230", "2024-04-01", None]],
                               "provnum string, workdate string")
    out = curate.build_fact(df, drop=("workdate",), run_id="r1", run_ts=dt.datetime(2024, 7, 1))
    first = out.where("work_date is not null").first()
    assert (first.work_year, first.work_month, first.work_day) == (2024, 4, 1)
    assert curate.bad_date_count(out).first()[0] == 4


def test_profile_flags(spark):
    rows = [(str(i) if i < 8 else "x", str(i) if i < 7 else "y", "c", None, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "a string, b string, k string, n string, v double")
    p = {r.column_name: r for r in profile.column_profile(df, "t").collect()}
    assert p["a"].possible_type_issue == profile.NUMERIC_LIKE_ISSUE
    assert p["b"].possible_type_issue == ""
    assert p["k"].constant_column_flag is True and p["n"].constant_column_flag is True
    assert p["n"].possible_type_issue == "" and p["n"].high_missing_flag is True
    assert p["n"].missing_pct == 100.0 and p["v"].completeness_pct == 100.0


def test_profile_empty_table(spark):
    df = spark.createDataFrame([], "a string, v double")
    p = profile.column_profile(df, "t").collect()
    assert all(r.missing_pct == 0.0 and r.row_count == 0 for r in p)
    d = profile.duplicate_rows(df, "t").first()
    assert d.duplicate_row_count == 0 and d.duplicate_row_pct == 0.0


def test_exact_quantiles_match_pandas(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(7)
    vals = np.round(rng.normal(50, 20, 997), 2).tolist() + [1.0, 2.0, 3.0, 10.0] * 3
    df = spark.createDataFrame([(v, v * 2) for v in vals], "x double, y double")
    q = {(r.column_name, r.prob): r.value for r in profile.exact_quantiles(df, ["x", "y"], partitions=5).collect()}
    s = pd.Series(vals)
    for p in (0.25, 0.5, 0.75):
        assert q[("x", p)] == pytest.approx(s.quantile(p), abs=1e-9)
        assert q[("y", p)] == pytest.approx((s * 2).quantile(p), abs=1e-9)


def test_iqr_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]] + [(None,)], "v double")
    r = profile.iqr_outliers(df, ["v"], "t").first()
    assert r.outlier_count == 1 and r.outlier_pct == 10.0


def test_missing_dates_gap(spark):
    df = spark.createDataFrame([(dt.date(2024, 4, d),) for d in (1, 2, 5)], "d date")
    got = sorted(r.missing_date for r in checks.missing_dates(df, "d").collect())
    assert got == [dt.date(2024, 4, 3), dt.date(2024, 4, 4)]


def test_range_violations_text(spark):
    df = spark.createDataFrame([("-1",), ("5",), ("12",), ("abc",), (None,)], "x string")
    assert sorted(r.x for r in checks.range_violations(df, "x", 0, 10).collect()) == ["-1", "12"]


def test_dashboard_single_key_column(spark, fact, ref):
    dim = _dim(fact, ref)
    out = serve.dashboard(fact, dim, "provnum", {"in_hospital_flg": "provider_reference_gap_flag",
                                                   "overall_rating": "overall_rating"})
    assert out.columns.count("provnum") == 1 and out.count() == fact.count()


def test_distinct_chunks_match_single_aggregate(spark):
    df = spark.createDataFrame([(i % 3, i % 5, str(i % 7), None) for i in range(50)], "a int, b int, c string, d string")
    one = {r.column_name: r.unique_non_null_values
           for r in profile.column_profile(df, "t", distinct_chunk=10).collect()}
    chunked = {r.column_name: r.unique_non_null_values
               for r in profile.column_profile(df, "t", distinct_chunk=1).collect()}
    assert one == chunked == {"a": 3, "b": 5, "c": 7, "d": 0}


def test_infer_types_like_a_csv_reader(spark):
    rows = [("1", "1", "1.5", "True", "a", None), ("2", None, "2", "False", "1", None), (" 3 ", "3", "x" if False else "3e1", "true", "b", None)]
    df = spark.createDataFrame(rows, "i string, i_gap string, f string, b string, s string, empty string")
    got = {r.column_name: r.inferred_type for r in profile.infer_types(df).collect()}
    assert got == {"i": "bigint", "i_gap": "double", "f": "double", "b": "boolean", "s": "string",
                   "empty": "double"}


def test_exact_quantiles_without_exchange_reuse(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 102)], "x double")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        q = {r.prob: r.value for r in profile.exact_quantiles(df, ["x"], partitions=7).collect()}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    assert q == {0.25: 26.0, 0.5: 51.0, 0.75: 76.0}


def test_key_report_declared_and_single_row(spark):
    from lakeq.models.staffing import DATASET_KEYS
    assert len(DATASET_KEYS) == 21
    one = spark.createDataFrame([(1.5, 2.5)], "a double, b double")
    two = one.unionByName(one)
    empty = spark.createDataFrame([], "a double")
    got = {r.table_name: r for r in checks.key_reports(
        {"one": (one, []), "two": (two, []), "empty": (empty, []), "keyed": (two, ["a"])}).collect()}
    assert got["one"].key_unique and got["one"].distinct_keys == 1
    assert not got["two"].key_unique and got["two"].duplicate_key_rows == 2
    assert got["empty"].row_count == 0 and got["empty"].distinct_keys == 0 and got["empty"].key_unique
    assert got["keyed"].duplicate_key_rows == 2


def test_survivor_order(spark):
    df = spark.createDataFrame([("k", 1, "old"), ("k", 3, "new"), ("k", 2, "mid")], "k string, v int, s string")
    assert curate.survivor(df, "k").first().s == "old"
    assert curate.survivor(df, "k", order_by=[-F.col("v")]).first().s == "new"


def test_profile_composite(spark):
    df = spark.createDataFrame([("1", 2.0), ("2", 4.0), ("2", 4.0), (None, 100.0)], "a string, v double")
    out = profile.profile(df, "t")
    assert set(out) == {"overview", "catalog", "duplicates", "columns", "missing_ranking", "numeric_summary",
                        "outliers"}
    assert out["overview"].first().row_count == 4
    assert out["duplicates"].first().duplicate_row_count == 1
    assert [r.column_name for r in out["missing_ranking"].collect()][0] == "a"
    ns = out["numeric_summary"].first()
    assert (ns["count"], ns["p50"], ns["max"]) == (4, 4.0, 100.0)
    types = {r.column_name: r.inferred_type for r in profile.infer_types(df).collect()}
    typed = profile.apply_inferred_types(df, types)
    assert dict(typed.dtypes) == {"a": "double", "v": "double"}


def test_approximate_options_close_to_exact(spark):
    df = spark.createDataFrame([(float(i % 97), str(i % 13)) for i in range(2000)], "x double, s string")
    exact = profile.numeric_summary(df, ["x"], "t").first()
    approx = profile.numeric_summary(df, ["x"], "t", exact=False).first()
    for q in ("p25", "p50", "p75"):
        assert abs(exact[q] - approx[q]) <= 1.0
    d = {r.column_name: r.unique_non_null_values for r in profile.column_profile(df, "t", approx_distinct=True).collect()}
    assert abs(d["x"] - 97) <= 10 and abs(d["s"] - 13) <= 2  # HLL++ default relative error 5%


def test_missing_dates_per_group(spark):
    rows = [("a", dt.date(2024, 4, d)) for d in (1, 3)] + [("b", dt.date(2024, 4, d)) for d in (2, 3, 6)]
    df = spark.createDataFrame(rows, "k string, d date")
    got = sorted((r.k, r.missing_date.day) for r in checks.missing_dates(df, "d", by=["k"]).collect())
    assert got == [("a", 2), ("b", 4), ("b", 5)]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 5)] + [(float("nan"),), (None,)], "x double")
    col = profile.column_profile(df, "t").first()
    assert (col.non_null_count, col.missing_count, col.unique_non_null_values) == (5, 2, 5)
    num = profile.numeric_summary(df, ["x"], "t").first()
    assert (num["count"], num["mean"], num["max"], num["p50"]) == (5, 3.0, 5.0, 3.0) and round(num["std"], 2) == 1.58
    assert profile.iqr_outliers(df, ["x"], "t").first().outlier_count == 0
    assert profile.missing_counts(df, "t").first().missing_count == 2
    assert checks.range_violations(df, "x", 0, 4).count() == 1


def test_measures_keep_their_digits(spark):
    small = spark.range(1000).selectExpr("CAST(0.004 AS DECIMAL(10,3)) AS x", "0.004D AS y", "1 AS g")
    assert serve.total_by(small, ["g"], ["x"]).first().total_hours == 4.0
    assert abs(serve.total_by(small, ["g"], ["y"]).first().total_hours - 4.0) < 1e-9
    near = spark.createDataFrame([(1, 0.02, 10**8), (2, 0.01, 10**8)], "k int, h double, n long")
    ratios = serve.load_ratio(near, "k", ["h"], F.sum("n"))
    assert [r.k for r in serve.bottom_k(ratios, "ratio", ["k"], 1).collect()] == [2]


def test_long_integers_keep_their_digits(spark):
    df = spark.createDataFrame([("1234567890123456789", "9" * 25), ("1234567890123456788", "7")], "a string, b string")
    types = {r.column_name: r.inferred_type for r in profile.infer_types(df).collect()}
    assert types == {"a": "bigint", "b": "string"}
    assert {r.a for r in profile.apply_inferred_types(df, types).collect()} == {1234567890123456789, 1234567890123456788}


def test_carried_column_of_the_reference_name(spark):
    ref = spark.createDataFrame([(1, 10)], "k int, v int")
    fact = spark.createDataFrame([(1, 5), (2, 777)], "k int, v int")
    dim = curate.build_dimension(ref, fact, ref_key="k", dim_key="k", fact_key="k", inferred_attrs={}, carried={"v": "v"},
                                 run_id="r", run_ts="2024-07-01 00:00:00")
    assert sorted((r.k, r.v) for r in dim.collect()) == [(1, 10), (2, 777)]


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1.0, "x"), (2.0, "y")], "`a.b` double, `c``d` string")
    assert profile.numeric_summary(df, ["a.b"], "t").first()["mean"] == 1.5
    assert profile.iqr_outliers(df, ["a.b"], "t").count() == 1 and profile.column_profile(df, "t").count() == 2
    from lakeq.functions.names import standardize_columns
    assert standardize_columns(df).columns == ["a_b", "c_d"]


def test_text_dates_with_a_bad_value(spark):
    df = spark.createDataFrame([("2024-04-01",), ("2024-04-03",), ("no date",)], "d string")
    assert [str(r[0]) for r in checks.missing_dates(df, "d").collect()] == ["2024-04-02"]
    assert str(checks.date_bounds(df, "d").first().max_date) == "2024-04-03"


def test_occupancy(spark):
    fact = spark.createDataFrame([("a", 10), ("a", 20), ("b", 5), ("c", 1)], "k string, census int")
    dim = spark.createDataFrame([("a", 30), ("b", 0)], "k string, beds int")
    got = {r.k: r.occupancy for r in serve.occupancy(fact, "k", "census", dim, "beds").collect()}
    assert got == {"a": 0.5, "b": None, "c": None}

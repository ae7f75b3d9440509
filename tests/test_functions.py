"""Edge rows of the column functions (FIXTURES §4)."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from lakeq.contracts import ContractError, TableContract
from lakeq.functions import (blank_to_null, clean_file_name, lenient_cast, lenient_int, na_to_null,
                             numeric_text_ok, parse_date, standardize_columns, standardize_name,
                             whitespace_to_null)
from lakeq.operators.refine import cast_loss, refine


def _one(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_standardize_name():
    assert standardize_name("  Hrs_RNDON_emp ") == "hrs_rndon_emp"
    assert standardize_name("CMS Certification Number (CCN)") == "cms_certification_number_ccn"
    assert standardize_name("City/Town") == "city_town"
    assert standardize_name("Footnote -- Achievement Score") == "footnote_achievement_score"


def test_header_collision_raises(spark):
    df = spark.createDataFrame([("1", "2")], "`A B` string, `A-B` string")
    with pytest.raises(ContractError):
        standardize_columns(df)


def test_blank_and_whitespace(spark):
    vals = ["", "   ", "\t ", "x", None]
    assert _one(spark, vals, blank_to_null) == [None, None, "\t", "x", None]
    assert _one(spark, vals, whitespace_to_null) == [None, None, None, "x", None]


def test_na_tokens_only_in_profile_reader(spark):
    vals = ["NA", "N/A", "-", ".", "unknown", "015009"]
    assert _one(spark, vals, na_to_null) == [None] * 5 + ["015009"]
    assert _one(spark, vals, blank_to_null) == vals


def test_lenient_int_matches_legacy(spark):
    vals = ["3", "3.0", "12.7", "-1.9", ".5", "1e2", "1,000", "99999999999"]
    assert _one(spark, vals, lenient_int) == [3, 3, 12, -1, 0, None, None, None]


def test_decimal_casts(spark):
    assert _one(spark, ["1.005", "1e2"], lambda c: lenient_cast(c, "decimal(10,2)")) == [
        decimal.Decimal("1.01"), decimal.Decimal("100.00")]
    assert _one(spark, ["123.4567"], lambda c: lenient_cast(c, "decimal(9,7)")) == [None]


def test_dates(spark):
    vals = ["20240401", "20241301", "20240230", "2024-04-01", None]
    assert _one(spark, vals, parse_date) == [dt.date(2024, 4, 1), None, None, None, None]


def test_numeric_look_alikes(spark):
    vals = ["1d", "NaN", "Infinity", "1e5", " 12 ", "abc"]
    assert _one(spark, vals, numeric_text_ok) == [False, False, False, True, True, False]


def test_clean_file_name(spark):
    vals = [None, "", "  my file/part\\1 ", "data.csv", "   "]
    assert _one(spark, vals, clean_file_name) == [
        "unknown.csv", "unknown.csv", "my_file_part_1.csv", "data.csv", ".csv"]


def test_refine_contract_and_cast_loss(spark):
    raw = spark.createDataFrame(
        [("015009", " 3.0 ", "123.4567", ""), ("015010", "12.7", "1.5", "  ")],
        "`PROVNUM` string, `MDS Census` string, `Ratio` string, `Note` string")
    contract = TableContract("t", {"provnum": "string", "mds_census": "int", "ratio": "decimal(9,7)",
                                   "hrs_cna": "decimal(10,2)"})
    out = refine(raw, contract)
    rows = out.df.orderBy("provnum").collect()
    assert [r.provnum for r in rows] == ["015009", "015010"]
    assert [r.mds_census for r in rows] == [3, 12]
    assert rows[0].ratio is None and rows[1].ratio == decimal.Decimal("1.5000000")
    assert rows[0].note is None and rows[1].note is None
    assert any("hrs_cna" in w for w in out.warnings)
    loss = {r.column_name: r.cast_loss for r in cast_loss(raw, contract).collect()}
    assert loss == {"provnum": 0, "mds_census": 0, "ratio": 1}

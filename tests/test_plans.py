"""Plan shape of every registered query, and the DuckDB oracle at sf0.001."""

import contextlib
import io
import math
import decimal
import datetime as dt
from collections import Counter

import pytest

from __spark_entry__ import entry
from lakeq.operators import checks
from lakeq.plans.oracle import ORACLE
from lakeq.plans.queries import QUERIES
from lakeq.plans.tables import TABLES, load

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "percentile(")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad} in plan"


def test_scans_are_pruned(spark):
    plan = _plan(QUERIES["hours_by_type"](spark, SF))
    read = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert read and all("l_orderkey" not in line for line in read)


def _executed(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    final = buf.getvalue().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final
    return final


def test_validation_shuffles_the_wide_fact_once(spark):
    """Executed plan without broadcasts: one exchange carries fact columns beside
    the keys; all others are of keys and counts."""
    off = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in off}
    try:
        for k in off:
            spark.conf.set(k, "-1")
        df = QUERIES["validation_summary"](spark, SF)
        df.collect()
        node = df._jdf.queryExecution().executedPlan()
        text = node.toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    lines = text.splitlines()
    wide = 0
    for i, line in enumerate(lines):
        if " Exchange hashpartitioning(" in line and "ReusedExchange" not in line:
            below = next(x for x in lines[i + 1:] if "WholeStageCodegen" not in x)
            wide += "l_extendedprice" in below or "__lq_negative" in below
    assert wide <= 1


def test_no_sort_aggregate_over_a_fact_scan(spark):
    """The survivor's minimum sorts collapsed rows: a hash aggregate comes first."""
    text = _executed(QUERIES["dim_with_inferred"](spark, SF))
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "SortAggregate" in line:
            below = " ".join(lines[i + 1:i + 6])
            assert "HashAggregate" in below or "Exchange" in below or "SortAggregate" in below


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() == 8 and df.columns == ["metric_name", "metric_value", "severity"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == want


def test_refine_has_no_shuffle(spark):
    plan = _plan(QUERIES["refine_typed"](spark, SF))
    assert "Exchange" not in plan


def test_range_filter_pushed_to_scan(spark):
    plan = _plan(checks.range_violations(load(spark, SF, "customer"), "c_acctbal", 0, 9000))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert pushed and any("c_acctbal" in line for line in pushed)


@pytest.mark.parametrize("hot", [False, True])
def test_large_side_is_read_once_beside_its_counts(spark, hot):
    """Counts of the keys and the join: two reads, whether there are hot keys or not."""
    li = load(spark, SF, "lineitem")
    df = checks.duplicate_key_rows(li, ["l_suppkey", "l_linenumber"], target_rows=100 if hot else 10**9)
    # without hot keys their empty branch is cut off, and with it the counts' first mention
    assert _executed(df).count("FileScan parquet") == (2 if hot else 1)


def test_validation_evaluates_its_rules_once(spark, monkeypatch):
    """All that run_validation writes or counts comes from one written table of findings each."""
    from lakeq.operators import validate
    read = []
    real = validate.quarantine_rows
    monkeypatch.setattr(validate, "quarantine_rows", lambda df, *a: read.append(_plan(df)) or real(df, *a))
    counted = []
    real_counters = validate.counters
    monkeypatch.setattr(validate, "counters", lambda *a: counted.append(real_counters(*a)) or counted[0])
    QUERIES["validation_run"](spark, SF)
    assert len(read) == 2 and all("Join" not in p and "Exchange" not in p for p in read)
    assert "Join" not in _plan(counted[0])


def test_validation_shuffles_no_key_counts_beside_the_rows(spark):
    """The rows, the reference's keys and the rows of each reference key: three exchanges."""
    from lakeq.operators import validate
    from lakeq.plans.queries import LINEITEM_RULES
    from lakeq.plans.tables import lineitem_staged, orders_reference
    tagged = validate.tag_fact(lineitem_staged(spark, SF), orders_reference(spark, SF), LINEITEM_RULES)
    assert sum("Exchange" in line and "Broadcast" not in line and "Reused" not in line
               for line in _executed(tagged).splitlines()) <= 3


def test_drop_mode_reads_its_clean_rows_and_the_reference_from_written_tables(spark, monkeypatch):
    from lakeq.operators import validate
    plans, real = {}, validate.run_validation
    monkeypatch.setattr(validate, "run_validation", lambda rows, ref, rules, run_id, **k: plans.update(
        {run_id: _plan(rows) + _plan(ref)}) or real(rows, ref, rules, run_id=run_id, **k))
    QUERIES["gate_outcomes"](spark, SF)
    assert len(plans) == 5
    assert "Exchange" not in plans["clean"] and "Join" not in plans["clean"]


def test_quarantine_of_a_run_is_written_from_its_findings_without_a_shuffle(spark, monkeypatch):
    from lakeq.sources import sinks
    asked, real = [], sinks.write_quarantine
    monkeypatch.setattr(sinks, "write_quarantine", lambda *a, **k: asked.append(k.get("rebalance")) or real(*a, **k))
    QUERIES["validation_run"](spark, SF)
    assert asked == [False, False]


def test_landed_text_is_compressed_in_files_of_bounded_length(spark, monkeypatch, tmp_path):
    from lakeq.plans import queries
    monkeypatch.setattr(queries, "LANDED_ROWS", 50)
    monkeypatch.setattr(queries, "scratch_path", lambda _, name: str(tmp_path / name))
    rows = QUERIES["stage_ledger"](spark, SF).collect()
    refined = {(r.run_id, r.metric): r.value for r in rows if r.stage == "refine"}
    for run in ("r1", "r2"):
        files = sorted((tmp_path / "stages" / "raw" / run).glob("part-*"))
        assert files and all(f.name.endswith(".csv.gz") for f in files)
        lines = [spark.read.text(str(f)).count() - 1 for f in files]
        assert max(lines) <= 50 and sum(lines) == refined[run, "staffing_hours_rows"]

"""Landing, run stages, sinks and streaming on fresh temp directories."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from lakeq.contracts import GateError
from lakeq.models import staffing
from lakeq.plans.stages import Layout, curate_stage, refine_stage, run_stages, validate_stage
from lakeq.sources import sinks
from lakeq.sources.csv import read_csv_with_fallback
from lakeq.sources.manifest import (manifest_from_files, pending_files, read_manifest_document,
                                    select_dataset_file)
from lakeq.streaming import land_incrementally

RUN_TS = dt.datetime(2024, 7, 1)
# The staffing file header (33 columns, file order).
STAFF_HEADER = [
    "PROVNUM", "PROVNAME", "CITY", "STATE", "COUNTY_NAME", "COUNTY_FIPS", "CY_Qtr", "WorkDate", "MDScensus",
    "Hrs_RNDON", "Hrs_RNDON_emp", "Hrs_RNDON_ctr", "Hrs_RNadmin", "Hrs_RNadmin_emp", "Hrs_RNadmin_ctr",
    "Hrs_RN", "Hrs_RN_emp", "Hrs_RN_ctr", "Hrs_LPNadmin", "Hrs_LPNadmin_emp", "Hrs_LPNadmin_ctr",
    "Hrs_LPN", "Hrs_LPN_emp", "Hrs_LPN_ctr", "Hrs_CNA", "Hrs_CNA_emp", "Hrs_CNA_ctr",
    "Hrs_NAtrn", "Hrs_NAtrn_emp", "Hrs_NAtrn_ctr", "Hrs_MedAide", "Hrs_MedAide_emp", "Hrs_MedAide_ctr",
]


def _staff_row(prov, day, hours="8.5", name="A"):
    return [prov, name, "Town", "ST", "County", "001", "2024Q2", day, "40"] + [hours] * 24


def _write_csv(path, header, rows, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def _land(tmp, staff_rows, prov_rows):
    raw = os.path.join(tmp, "raw")
    os.makedirs(raw)
    _write_csv(f"{raw}/staffing.csv", STAFF_HEADER, staff_rows)
    prov_header = ["CMS Certification Number (CCN)", "Provider Name", "City/Town", "State",
                   "Number of Certified Beds", "Provider Resides in Hospital", "Overall Rating"]
    _write_csv(f"{raw}/provider.csv", prov_header, prov_rows)
    manifest = {"run_id": "r1", "source": "drive", "timestamp": "2024-07-01T00:00:00+00:00", "files": [
        {"dataset": "staffing_hours", "file_id": "1", "file_name": "staffing.csv", "s3_path": f"{raw}/staffing.csv",
         "size_bytes": os.path.getsize(f"{raw}/staffing.csv")},
        {"dataset": "provider_reference", "file_id": "2", "file_name": "provider.csv",
         "s3_path": f"{raw}/provider.csv", "size_bytes": os.path.getsize(f"{raw}/provider.csv")}]}
    mpath = os.path.join(tmp, "manifest.json")
    with open(mpath, "w") as f:
        json.dump(manifest, f, indent=2)
    return mpath


def test_stages_end_to_end(spark, tmp_dir):
    staff = [_staff_row("015009", "20240401"), _staff_row("015009", "20240402"),
             _staff_row("999999", "20240401", name="Z")]
    prov = [["015009", "Prov A", "Town", "ST", "120", "N", "4"], ["111111", "Unused", "X", "ST", "10", "Y", "2"]]
    mpath = _land(tmp_dir, staff, prov)
    layout = Layout(os.path.join(tmp_dir, "lake"))
    out = run_stages(spark, mpath, layout, "r1", RUN_TS)
    assert out["validation"]["unmatched_staffing_count"] == 1
    assert any("average_number_of_residents_per_day" in w for w in out["warnings"]["provider_reference"])
    dim = spark.table("dim_provider")
    assert {r.provnum: r.provider_match_status for r in dim.collect()} == {
        "015009": "matched", "999999": "inferred_from_staffing"}
    fact = spark.table("fact_staffing_daily")
    assert fact.count() == 3
    assert fact.where("work_year = 2024 AND work_month = 4").count() == 3
    refined = sinks.read_run(spark, layout.refined("staffing_hours"), "r1")
    assert dict(refined.dtypes)["hrs_cna"] == "decimal(10,2)" and dict(refined.dtypes)["mdscensus"] == "int"
    # serving views
    from lakeq.operators import serve
    dim_view = serve.contract_view(dim, staffing.dim_view_columns())
    assert len(dim_view.columns) == 109 and dim_view.columns[9] == "county_fips"
    assert "ingest_ts_utc" not in dim_view.columns
    fv = serve.fact_view(fact, dim, "provnum", staffing.DIM_FLAGS, staffing.fact_view_columns())
    assert len(fv.columns) == 39 and dict(fv.dtypes)["mdscensus"] == "decimal(10,2)"
    flags = {r.provnum: r.provider_reference_gap_flag for r in fv.select("provnum", "provider_reference_gap_flag").collect()}
    assert flags == {"015009": "N", "999999": "Y"}
    parity = serve.fact_view(fact, dim, "provnum", staffing.DIM_FLAGS, staffing.fact_view_columns(), parity=True)
    assert parity.where("provider_match_status IS NOT NULL").count() == 0
    # dashboard metrics over the published tables: 3 rows x 8.5 hours per type
    from lakeq.plans.stages import dashboard_metrics
    m = dashboard_metrics(spark)
    assert {r.measure_type: r.total_hours for r in m["hours_by_type"].collect()} == {
        t: 25.5 for t in ("rndon", "rnadmin", "rn", "lpnadmin", "lpn", "cna", "natrn", "medaide")}
    assert m["emp_vs_ctr"].first().emp_hours == 8 * 25.5
    assert {r.provnum for r in m["lowest_staffed"].collect()} == {"015009", "999999"}
    assert m["total_by_provider_state_month"].count() == 2
    census = {r.provnum: r.avg_census for r in m["occupancy"].collect()}
    assert {r.provnum: r.occupancy for r in m["occupancy"].collect()} == {"015009": census["015009"] / 120, "999999": None}
    assert m["reference_gap"].first().unmatched_keys == 1 and "load_vs_readmission" not in m
    rate = spark.createDataFrame([("015009", 0.2), ("999999", 0.1)], "provnum string, readmission_rate double")
    assert dashboard_metrics(spark, readmissions=rate)["load_vs_readmission"].first().n_pairs == 2
    assert refined.select("provnum").distinct().where("provnum = '015009'").count() == 1
    # Another run over the same files has nothing to do, the same run may be repeated
    assert run_stages(spark, mpath, layout, "r2", RUN_TS) == {"skipped": True}
    assert not run_stages(spark, mpath, layout, "r1", RUN_TS)["skipped"] and spark.table("fact_staffing_daily").count() == 3


def test_gate_fails_after_evidence_and_rerun_clears_quarantine(spark, tmp_dir):
    staff = [_staff_row("015009", "20240401"), _staff_row("015009", "20240401", hours="-1")]
    prov = [["015009", "Prov A", "Town", "ST", "120", "N", "4"]]
    mpath = _land(tmp_dir, staff, prov)
    layout = Layout(os.path.join(tmp_dir, "lake"))
    refine_stage(spark, mpath, layout, "r1", RUN_TS)
    with pytest.raises(GateError):
        validate_stage(spark, layout, "r1", RUN_TS)
    summary = {r.metric_name: r.metric_value for r in spark.read.parquet(layout.summary("r1")).collect()}
    assert summary["staffing_duplicate_count"] == 2 and summary["negative_hours_count"] == 1
    q = spark.read.parquet(f"{layout.quarantine}/staffing/run_id=r1")
    assert {r.quarantine_reason for r in q.select("quarantine_reason").distinct().collect()} == {
        "duplicate_staffing_keys", "negative_staffing_hours"}
    # a clean rerun of the same run must not leave the old bad rows behind
    clean = spark.read.parquet(f"{layout.base}/refined/staffing_hours/run_id=r1").limit(1)
    clean.write.mode("overwrite").parquet(f"{layout.base}/refined2/staffing_hours/run_id=r1")
    layout2 = Layout(layout.base)
    fixed = spark.read.parquet(f"{layout.base}/refined2/staffing_hours/run_id=r1").withColumn(
        "hrs_cna", F.abs("hrs_cna"))
    sinks.write_run(fixed.withColumn("hrs_rn", F.abs("hrs_rn")).select(
        [F.abs(c).alias(c) if c.startswith("hrs_") else F.col(c) for c in fixed.columns]),
        layout2.refined("staffing_hours"), "r1")
    outcome = validate_stage(spark, layout2, "r1", RUN_TS)
    assert outcome.passed
    qdir = f"{layout.quarantine}/staffing/run_id=r1"
    left = [f for _, _, fs in os.walk(qdir) for f in fs if f.endswith(".parquet")]
    assert left == []


def test_bad_dates_stop_curation(spark, tmp_dir):
    staff = [_staff_row("015009", "20241301")]
    mpath = _land(tmp_dir, staff, [["015009", "Prov A", "Town", "ST", "120", "N", "4"]])
    layout = Layout(os.path.join(tmp_dir, "lake"))
    refine_stage(spark, mpath, layout, "r1", RUN_TS)
    with pytest.raises(GateError):
        curate_stage(spark, layout, "r1", RUN_TS, publish=False)
    assert not os.path.exists(f"{layout.base}/curated")


def test_manifest_select_and_pending(spark, tmp_dir):
    mpath = _land(tmp_dir, [_staff_row("1", "20240401")], [["1", "P", "T", "S", "1", "N", "3"]])
    m = read_manifest_document(spark, mpath)
    assert select_dataset_file(m, "staffing_hours")["file_name"] == "staffing.csv"
    with pytest.raises(ValueError):
        select_dataset_file(m, "nope")
    listing = manifest_from_files(spark, os.path.join(tmp_dir, "raw", "*.csv"), run_id="r2", dataset="landing")
    processed = listing.where(F.col("file_name") == "staffing.csv")
    assert [r.file_name for r in pending_files(listing, processed).collect()] == ["provider.csv"]


def test_encoding_fallback(spark, tmp_dir):
    path = os.path.join(tmp_dir, "latin.csv")
    with open(path, "wb") as f:
        f.write(b"name,city\ncaf\xe9,Paris\n")
    df, enc = read_csv_with_fallback(spark, path)
    assert enc == "cp1252" and df.first().name == "café"
    with open(path, "wb") as f:
        f.write(b"name,city\ncaf\xe9 \x81,Paris\n")
    df, enc = read_csv_with_fallback(spark, path)
    assert enc == "latin1" and df.first().name == "café \x81"
    with open(path, "wb") as f:
        f.write("näme,city\ncafé \ufffd,Paris\n".encode())
    df, enc = read_csv_with_fallback(spark, path)
    assert enc == "utf-8" and df.columns == ["näme", "city"] and df.first()[0] == "café \ufffd"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_csv_with_fallback(spark, os.path.join(tmp_dir, "no such file.csv"))


def test_partition_overwrite_modes(spark, tmp_dir):
    path = os.path.join(tmp_dir, "fact")
    df = spark.createDataFrame([(1, 2024, 4), (2, 2024, 5)], "v int, work_year int, work_month int")
    sinks.write_partitioned(df, path)
    sinks.write_partitioned(df.where("work_month = 5"), path, dynamic=True)
    assert spark.read.parquet(path).count() == 2
    sinks.write_partitioned(df.where("work_month = 5"), path)
    assert spark.read.parquet(path).count() == 1


def test_catalog_table_discovers_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "cat")
    df = spark.createDataFrame([(1, 2024, 4), (2, 2024, 5)], "v int, work_year int, work_month int")
    sinks.write_partitioned(df, path)
    spark.sql("DROP TABLE IF EXISTS t_cat")
    sinks.register_table(spark, "t_cat", path, "v int, work_year int, work_month int", ("work_year", "work_month"))
    assert spark.table("t_cat").count() == 2


def test_streaming_landing_processes_each_file_once(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    _write_csv(f"{landing}/a.csv", STAFF_HEADER, [_staff_row("1", "20240401"), _staff_row(None or "", "20240402")])
    kw = dict(contract=staffing.STAFFING, rules=staffing.RULES, out_path=os.path.join(tmp_dir, "out"),
              quarantine_path=os.path.join(tmp_dir, "q"), checkpoint=os.path.join(tmp_dir, "ckpt"),
              run_id="r1", dataset="staffing_hours", run_ts=RUN_TS)
    land_incrementally(spark, landing, **kw)
    _write_csv(f"{landing}/b.csv", STAFF_HEADER, [_staff_row("2", "20240403", hours="-2")])
    land_incrementally(spark, landing, **kw)
    land_incrementally(spark, landing, **kw)  # nothing new
    out = spark.read.parquet(kw["out_path"])
    assert sorted(r.provnum for r in out.collect()) == ["1"]
    assert {r.source_file_name for r in out.collect()} == {"a.csv"}
    q = spark.read.parquet(kw["quarantine_path"])
    assert sorted(r.quarantine_reason for r in q.collect()) == [
        "missing_required_staffing_fields", "negative_staffing_hours"]


def test_empty_dataset_fails_before_writes(spark, tmp_dir):
    from lakeq.operators.validate import run_validation
    fact = spark.createDataFrame([], "provnum string, workdate string, hrs_cna double")
    ref = spark.createDataFrame([("1",)], "cms_certification_number_ccn string")
    with pytest.raises(GateError):
        run_validation(fact, ref, staffing.RULES, run_id="r1", run_ts=RUN_TS,
                       quarantine_base=os.path.join(tmp_dir, "q"), summary_path=os.path.join(tmp_dir, "s"))
    assert not os.path.exists(os.path.join(tmp_dir, "s"))


def test_duplicate_csv_headers_are_renamed_by_the_reader(spark, tmp_dir):
    from lakeq.functions.names import standardize_columns
    from lakeq.sources.csv import read_csv_strings
    path = os.path.join(tmp_dir, "dup.csv")
    _write_csv(path, ["A B", "A B", "C"], [["1", "2", "3"]])
    df = read_csv_strings(spark, path)
    assert len(set(df.columns)) == 3 and all(c.startswith("A B") for c in df.columns[:2])
    assert standardize_columns(df).columns[2] == "c"


def test_manifest_last_entry_wins(spark, tmp_dir):
    doc = {"run_id": "r9", "source": "drive", "timestamp": "t", "files": [
        {"dataset": "staffing_hours", "file_id": "1", "file_name": "old.csv", "s3_path": "/x/old.csv", "size_bytes": 1},
        {"dataset": "provider_reference", "file_id": "2", "file_name": "p.csv", "s3_path": "/x/p.csv", "size_bytes": 2},
        {"dataset": "staffing_hours", "file_id": "3", "file_name": "new.csv", "s3_path": "/x/new.csv", "size_bytes": 3}]}
    path = os.path.join(tmp_dir, "m.json")
    with open(path, "w") as f:
        json.dump(doc, f, indent=2)
    rec = select_dataset_file(read_manifest_document(spark, path), "staffing_hours")
    assert rec["file_name"] == "new.csv" and rec["path"] == "/x/new.csv"


def test_stream_equals_batch_on_same_files(spark, tmp_dir):
    from lakeq.operators import refine as refine_op
    from lakeq.operators.validate import any_negative, any_null
    from lakeq.contracts import Lineage
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    _write_csv(f"{landing}/a.csv", STAFF_HEADER, [_staff_row("1", "20240401"), _staff_row("2", "20240402", "-1")])
    _write_csv(f"{landing}/b.csv", STAFF_HEADER, [_staff_row("3", "20240403"), _staff_row("", "20240404")])
    kw = dict(contract=staffing.STAFFING, rules=staffing.RULES, out_path=os.path.join(tmp_dir, "out"),
              quarantine_path=os.path.join(tmp_dir, "q"), checkpoint=os.path.join(tmp_dir, "ckpt"),
              run_id="r1", dataset="staffing_hours", run_ts=RUN_TS, max_files_per_trigger=1)
    land_incrementally(spark, landing, **kw)
    streamed = spark.read.parquet(kw["out_path"]).drop("batch_id")
    raw = spark.read.option("header", True).csv(landing).withColumn("lq_source_file", F.col("_metadata.file_name"))
    batch = (refine_op.refine(raw, staffing.STAFFING, Lineage("r1", "staffing_hours", "", RUN_TS)).df
             .withColumn("source_file_name", F.col("lq_source_file")).drop("lq_source_file"))
    # (a wide OR used directly as a filter inside set operations can exhaust the
    # optimizer's constraint inference, so the tiny results are compared here)
    batch = batch.where(~any_null(staffing.RULES.fact_keys) & ~any_negative(batch, staffing.RULES.nonnegative))
    cols = sorted(batch.columns)
    assert sorted(streamed.columns) == cols
    rows = lambda df: sorted(repr(tuple(r)) for r in df.select(cols).collect())
    assert rows(streamed) == rows(batch) and len(rows(batch)) == 2


def test_publish_switches_view_between_runs(spark, tmp_dir):
    df1 = spark.createDataFrame([(1,)], "v int")
    df2 = spark.createDataFrame([(2,), (3,)], "v int")
    for run, df in (("r-1", df1), ("r-2", df2)):
        path = os.path.join(tmp_dir, run)
        sinks.write_table(df, path)
        sinks.publish(spark, "t_pub", path, run)
        assert spark.table("t_pub").count() == df.count()
    assert spark.table("t_pub__r_1__1").count() == 1


def test_encoding_fallback_uses_cp1252(spark, tmp_dir):
    path = os.path.join(tmp_dir, "euro.csv")
    with open(path, "wb") as f:
        f.write(b"price \x80\n5 \x80 \x93x\x94\n")
    df, enc = read_csv_with_fallback(spark, path)
    assert enc == "cp1252" and df.columns == ["price €"] and df.first()[0] == "5 € “x”"


def test_csv_quoting(spark, tmp_dir):
    from lakeq.sources.csv import read_csv_strings
    path = os.path.join(tmp_dir, "q.csv")
    with open(path, "w") as f:
        f.write('a,b\n"p ""q"" r","x\ny"\n')
    df = read_csv_strings(spark, path, multi_line=True)
    assert [tuple(r) for r in df.collect()] == [('p "q" r', "x\ny")]


def test_reordered_headers_fail(spark, tmp_dir):
    from lakeq.sources.csv import read_csv_strings
    landing = os.path.join(tmp_dir, "mixed")
    os.makedirs(landing)
    _write_csv(f"{landing}/a.csv", ["A", "B"], [["a1", "b1"]])
    _write_csv(f"{landing}/b.csv", ["B", "A"], [["b2", "a2"]])
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_strings(spark, landing).collect()
    _write_csv(f"{landing}/b.csv", ["A", "B"], [["a2", "b2"]])
    assert read_csv_strings(spark, landing).count() == 2


def test_replayed_manifest_adds_no_rows(spark, tmp_dir):
    from lakeq.sources.manifest import last_entries, write_manifest
    rows = spark.createDataFrame([("r1", "d", "/a", 1, 0), ("r1", "d", "/b", 2, 1)],
                                 "run_id string, dataset string, path string, size_bytes long, pos long")
    base = os.path.join(tmp_dir, "m")
    write_manifest(rows, base)
    write_manifest(rows.withColumn("run_id", F.lit("r2")), base)
    write_manifest(rows, base)
    assert spark.read.json(base).count() == 4
    assert [r.path for r in last_entries(rows.repartition(2)).collect()] == ["/b"]
    with pytest.raises(ValueError, match="pos"):
        last_entries(rows.drop("pos"))


def test_rerun_with_new_column_and_dropped_partition(spark, tmp_dir):
    df = spark.createDataFrame([(1, 4), (2, 5)], "v int, work_month int")
    a, b = os.path.join(tmp_dir, "one"), os.path.join(tmp_dir, "two")
    sinks.write_partitioned(df, a, ("work_month",))
    first = sinks.publish(spark, "t_rerun", a, "r1", partition_cols=("work_month",), attempt="a")
    sinks.write_partitioned(df.where("v = 1").withColumn("extra", F.lit("x")), b, ("work_month",))
    sinks.publish(spark, "t_rerun", b, "r1", partition_cols=("work_month",), attempt="b")
    assert [r.asDict() for r in spark.table("t_rerun").collect()] == [{"v": 1, "extra": "x", "work_month": "4"}] or [
        int(r.work_month) for r in spark.table("t_rerun").collect()] == [4]
    assert "extra" in spark.table("t_rerun").columns and spark.table(first).count() == 2


def test_manifest_write_read_roundtrip(spark, tmp_dir):
    from lakeq.sources.manifest import write_manifest, write_manifest_document
    mpath = _land(tmp_dir, [_staff_row("1", "20240401")], [["1", "P", "T", "S", "1", "N", "3"]])
    listing = manifest_from_files(spark, os.path.join(tmp_dir, "raw", "*.csv"), run_id="r5", dataset="landing")
    doc_dir = os.path.join(tmp_dir, "doc")
    write_manifest_document(listing, doc_dir, "2024-07-01T00:00:00+00:00")
    back = read_manifest_document(spark, doc_dir)
    assert sorted((r.file_name, r.size_bytes) for r in back.collect()) == sorted(
        (r.file_name, r.size_bytes) for r in listing.collect())
    table_dir = os.path.join(tmp_dir, "table")
    write_manifest(listing, table_dir)
    write_manifest(listing.withColumn("run_id", F.lit("r6")), table_dir)
    runs = spark.read.json(table_dir).groupBy("run_id").count().collect()
    assert {r.run_id: r["count"] for r in runs} == {"r5": 2, "r6": 2}


def test_profile_file_like_the_notebooks(spark, tmp_dir):
    from lakeq.plans.discovery import profile_file
    path = os.path.join(tmp_dir, "p.csv")
    rows = [["015009", "20240401", "10", "N/A"], ["015009", "20240402", "12.5", "ok"],
            ["015010", "20240405", " ", "ok"], ["015010", "20240405", "100", "x"]]
    _write_csv(path, ["PROVNUM", "WorkDate", "Hours", "Note"], rows)
    out = profile_file(spark, path, key=["PROVNUM", "WorkDate"], date_column="WorkDate")
    assert out["encoding"] == "utf-8"
    assert out["types"] == {"PROVNUM": "bigint", "WorkDate": "bigint", "Hours": "double", "Note": "string"}
    assert out["overview"].first().row_count == 4
    cols = {r.column_name: r for r in out["columns"].collect()}
    assert cols["Hours"].missing_count == 1 and cols["Note"].missing_count == 1
    assert out["duplicate_keys"].count() == 2
    assert sorted(str(r.missing_date) for r in out["missing_dates"].collect()) == ["2024-04-03", "2024-04-04"]
    assert {r.column_name for r in out["numeric_summary"].collect()} == {"PROVNUM", "WorkDate", "Hours"}


def test_key_report_files_with_declared_keys(spark, tmp_dir):
    from lakeq.plans.discovery import key_report_files
    a, b = os.path.join(tmp_dir, "a.csv"), os.path.join(tmp_dir, "b.csv")
    _write_csv(a, ["State", "5 Stars"], [["AK", "1"], ["AL", "2"], ["AK", "3"]])
    _write_csv(b, ["Baseline Period: FY 2019 National Average Readmission Rate"], [["0.2"]])
    got = {r.table_name: r for r in key_report_files(spark, {
        "NH_HlthInspecCutpointsState_Oct2024": a, "FY_2024_SNF_VBP_Aggregate_Performance": b}).collect()}
    assert got["NH_HlthInspecCutpointsState_Oct2024"].duplicate_key_rows == 2
    assert got["FY_2024_SNF_VBP_Aggregate_Performance"].key_unique


def test_run_stages_refines_only_new_content_and_resumes(spark, tmp_dir, monkeypatch):
    from lakeq.plans import stages
    from lakeq.sources import ledger, snapshots
    prov = [["015009", "Prov A", "Town", "ST", "120", "N", "4"]]
    mpath = _land(tmp_dir, [_staff_row("015009", "20240401")], prov)
    layout = Layout(os.path.join(tmp_dir, "lake"))
    assert run_stages(spark, mpath, layout, "r1", RUN_TS)["started_at"] == "refine"
    assert run_stages(spark, mpath, layout, "r2", RUN_TS) == {"skipped": True}
    # a change of equal size: only that dataset is refined, the other's rows are those of r1
    staffing_file = os.path.join(tmp_dir, "raw", "staffing.csv")
    size = os.path.getsize(staffing_file)
    _write_csv(staffing_file, STAFF_HEADER, [_staff_row("015009", "20240402")])
    assert os.path.getsize(staffing_file) == size
    # the run dies once validated; it goes on at curation and no stage before is run again
    with monkeypatch.context() as m:
        m.setattr(stages, "curate_stage", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("executors lost")))
        with pytest.raises(RuntimeError):
            run_stages(spark, mpath, layout, "r3", RUN_TS)
    states = {(r.run_id, r.dataset, r.state) for r in ledger.read_files(spark, layout.files).collect()}
    assert ("r3", "staffing_hours", "landed") in states and ("r3", "staffing_hours", "published") not in states
    assert {r.work_date for r in snapshots.open_snapshot(spark, stages.SNAPSHOT)["fact_staffing_daily"].collect()} == {
        dt.date(2024, 4, 1)}
    with monkeypatch.context() as m:
        for name in ("refine_stage", "validate_stage"):
            m.setattr(stages, name, lambda *a, **k: pytest.fail("run again"))
        out = run_stages(spark, mpath, layout, "r3", RUN_TS, resume=True)
    assert out["started_at"] == "curate" and out["runs"] == {"provider_reference": "r1"}
    assert out["validation"]["unmatched_staffing_count"] == 0
    assert not os.path.exists(sinks.run_path(layout.refined("provider_reference"), "r3"))
    served = snapshots.open_snapshot(spark, stages.SNAPSHOT)
    assert {r.work_date for r in served["fact_staffing_daily"].collect()} == {dt.date(2024, 4, 2)}
    assert [r.provider_match_status for r in served["dim_provider"].collect()] == ["matched"]
    assert run_stages(spark, mpath, layout, "r3", RUN_TS, resume=True)["started_at"] is None
    # other files under the same run: nothing of it counts as done
    _write_csv(staffing_file, STAFF_HEADER, [_staff_row("015009", "20240403")])
    assert run_stages(spark, mpath, layout, "r3", RUN_TS, resume=True)["started_at"] == "refine"


def test_run_stages_stops_at_failed_gate(spark, tmp_dir):
    staff = [_staff_row("015009", "20240401", hours="-3")]
    mpath = _land(tmp_dir, staff, [["015009", "Prov A", "Town", "ST", "120", "N", "4"]])
    layout = Layout(os.path.join(tmp_dir, "lake"))
    with pytest.raises(GateError):
        run_stages(spark, mpath, layout, "r7", RUN_TS)
    assert os.path.exists(layout.summary("r7"))                       # evidence written first
    assert not os.path.exists(f"{layout.base}/curated")   # curation never ran


def test_validation_drop_mode_passes_clean_rows_on(spark, tmp_dir):
    from lakeq.operators.validate import run_validation
    fact = spark.createDataFrame([("1", "d1", 1.0), ("1", "d1", 2.0), ("2", "d2", -1.0), ("3", "d3", 4.0)],
                                 "provnum string, workdate string, hrs_cna double")
    ref = spark.createDataFrame([("1",), ("2",)], "cms_certification_number_ccn string")
    out = run_validation(fact, ref, staffing.RULES, run_id="r1", run_ts=RUN_TS, mode="drop",
                         quarantine_base=os.path.join(tmp_dir, "q"), summary_path=os.path.join(tmp_dir, "s"))
    assert not out.passed and out.critical_total == 3
    assert sorted(r.provnum for r in out.clean.collect()) == ["3"]   # unmatched is only a warning

"""The ordered stages of a run — refine, validate, curate — stopping at the
first failed gate and re-raising it (trap T20).

Paths are plain parameters; every stage reads what the previous one wrote, so
a stage can be re-run alone after a failure. ``run_stages(resume=True)`` starts at the
first stage that a run with the same files has not finished. Only datasets whose file
has new content are refined; of the others the earlier run's refined rows are used.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeq.contracts import GateError, Lineage
from lakeq.models import staffing
from lakeq.operators import curate, refine, serve, validate
from lakeq.sources import ledger, sinks, snapshots
from lakeq.sources.csv import read_csv_strings
from lakeq.sources.manifest import last_entries, read_manifest_document, select_dataset_file

STAGES = ("refine", "validate", "curate")
CONTRACTS = {"staffing_hours": staffing.STAFFING, "provider_reference": staffing.PROVIDER}
SNAPSHOT = "staffing_snapshot"


@dataclass(frozen=True)
class Layout:
    """Where each stage reads and writes (any shared file system URI)."""

    base: str

    def refined(self, dataset: str) -> str:
        return f"{self.base}/refined/{dataset}"

    @property
    def quarantine(self) -> str:
        return f"{self.base}/quarantine"

    def summary(self, run_id: str) -> str:
        return f"{self.base}/validation_results/run_id={run_id}"

    def curated(self, table: str, run_id: str, attempt: str) -> str:
        return f"{self.base}/curated/{table}/run_id={run_id}/attempt={attempt}"

    @property
    def files(self) -> str:
        return f"{self.base}/file_ledger"

    @property
    def stages(self) -> str:
        return f"{self.base}/stage_ledger"


def refine_stage(spark: SparkSession, manifest_path: str, layout: Layout, run_id: str,
                 run_ts: dt.datetime, datasets=tuple(CONTRACTS)) -> dict[str, list[str]]:
    """S4 -> S1 -> C1 -> S7 for the datasets; returns the contract warnings."""
    manifest = read_manifest_document(spark, manifest_path)
    warnings = {}
    for dataset in datasets:
        contract = CONTRACTS[dataset]
        rec = select_dataset_file(manifest, dataset)
        raw = read_csv_strings(spark, rec["path"])
        out = refine.refine(raw, contract, Lineage(run_id, dataset, rec["file_name"], run_ts))
        sinks.write_run(out.df, layout.refined(dataset), run_id)
        warnings[dataset] = out.warnings
    return warnings


def _refined(spark: SparkSession, layout: Layout, run_id: str, runs: dict[str, str] | None) -> list[DataFrame]:
    """Refined staffing and provider rows, each of the run that ``runs`` names (else this one)."""
    return [sinks.read_run(spark, layout.refined(d), (runs or {}).get(d, run_id)) for d in CONTRACTS]


def validate_stage(spark: SparkSession, layout: Layout, run_id: str, run_ts: dt.datetime,
                   raise_on_failure: bool = True, runs: dict[str, str] | None = None) -> validate.ValidationOutcome:
    fact, ref = _refined(spark, layout, run_id, runs)
    return validate.run_validation(fact, ref, staffing.RULES, run_id=run_id, run_ts=run_ts,
                                   quarantine_base=layout.quarantine, summary_path=layout.summary(run_id),
                                   raise_on_failure=raise_on_failure)


def curate_stage(spark: SparkSession, layout: Layout, run_id: str, run_ts: dt.datetime,
                 keep_unreferenced: bool = False, publish: bool = True,
                 runs: dict[str, str] | None = None) -> dict[str, str]:
    """C3 + C4 with G4 before any write; both tables are written to the fresh
    directories of this attempt and only then published (trap T19): each under its
    name, and both at once in the snapshot's record."""
    attempt = uuid.uuid4().hex[:12]
    fact, ref = _refined(spark, layout, run_id, runs)
    dim = curate.build_dimension(ref, fact, ref_key="cms_certification_number_ccn", dim_key="provnum",
                                 fact_key="provnum", inferred_attrs=staffing.INFERRED_ATTRS,
                                 carried=staffing.CARRIED, run_id=run_id, run_ts=run_ts,
                                 keep_unreferenced=keep_unreferenced)
    fact_out = curate.build_fact(fact, date_col="workdate", drop=staffing.FACT_DROPS, run_id=run_id, run_ts=run_ts)
    bad = curate.bad_date_count(fact_out).first()["bad_workdate_count"]
    if bad:
        raise GateError(f"run {run_id}: {bad} rows of fact_staffing_daily have a work day that is no date")
    dim_path = layout.curated("dim_provider", run_id, attempt)
    fact_path = layout.curated("fact_staffing_daily", run_id, attempt)
    sinks.write_table(dim, dim_path)
    sinks.write_partitioned(fact_out, fact_path, ("work_year", "work_month"))
    if publish:
        snapshots.commit(spark, SNAPSHOT, {
            name: sinks.publish(spark, name, path, run_id, partition_cols=parts, attempt=attempt)
            for name, path, parts in (("dim_provider", dim_path, ()),
                                      ("fact_staffing_daily", fact_path, ("work_year", "work_month")))})
    return {"dim_provider": dim_path, "fact_staffing_daily": fact_path}


def run_stages(spark: SparkSession, manifest_path: str, layout: Layout, run_id: str,
               run_ts: dt.datetime | None = None, resume: bool = False, publish: bool = True) -> dict:
    """Refine -> validate -> curate; a failed gate stops the run and is raised.

    S14: files are known by content. When other runs have published every file of the
    manifest, nothing is done and the result says ``skipped``; datasets whose file they
    have published are not refined again. The files of a run count as published once
    its tables are; the same run may be repeated. ``publish=False`` writes the tables
    without putting them into the catalog; its files stay landed.

    C8: ``resume`` starts at the first stage that this run has not finished for the same
    files and refined runs; the result's ``started_at`` names it (None: all were done)."""
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    manifest = read_manifest_document(spark, manifest_path)
    entries = ledger.with_digests(spark, last_entries(manifest).select("dataset", "path", "size_bytes"))
    others = ledger.read_files(spark, layout.files).where(F.col("run_id") != run_id)
    known = ledger.known_files(entries, others).collect()  # a row for each dataset of one manifest
    if known and all(r["known_run"] for r in known):
        return {"skipped": True}
    runs = {r["dataset"]: r["refined_run"] for r in known if r["known_run"] and r["refined_run"]}
    rows = [(r["dataset"], r["path"], r["size_bytes"], r["digest"], runs.get(r["dataset"], run_id), run_ts) for r in known]
    files = spark.createDataFrame(rows, ledger.FILE_COLUMNS)
    named = sorted(f"{r[0]} {r[3] or uuid.uuid4().hex} {r[4]}" for r in rows)  # no digest: never the same inputs
    last = hashlib.sha256("\n".join(named).encode()).hexdigest()
    done = []
    if resume:
        done, last = ledger.finished_stages(spark, layout.stages, run_id, STAGES, last)

    def finish(stage: str, follows: str) -> str:
        record = uuid.uuid4().hex
        ledger.record_stage(spark, layout.stages, run_id, stage, record, follows)
        return record

    out = {"skipped": False, "started_at": next((s for s in STAGES if s not in done), None), "runs": runs,
           "warnings": {}, "tables": {}}
    if "refine" not in done:
        ledger.record_files(files, layout.files, run_id, "pending")
        out["warnings"] = refine_stage(spark, manifest_path, layout, run_id, run_ts, [d for d in CONTRACTS if d not in runs])
        ledger.record_files(files, layout.files, run_id, "landed")
        last = finish("refine", last)
    if "validate" not in done:
        out["validation"] = validate_stage(spark, layout, run_id, run_ts, runs=runs).counters
        last = finish("validate", last)
    else:
        summary = spark.read.parquet(layout.summary(run_id)).select("metric_name", "metric_value")
        out["validation"] = {r["metric_name"]: r["metric_value"] for r in summary.collect()}
    if "curate" not in done:
        out["tables"] = curate_stage(spark, layout, run_id, run_ts, runs=runs, publish=publish)
        if publish:
            ledger.record_files(files, layout.files, run_id, "published")
        finish("curate", last)
    return out


def dashboard_metrics(spark: SparkSession, fact_table: str = "fact_staffing_daily",
                      dim_table: str = "dim_provider", k: int = 10, readmissions: DataFrame | None = None,
                      rate_col: str = "readmission_rate") -> dict:
    """The dashboard's metrics (M1-M11) over the published tables, as DataFrames.

    ``readmissions`` (provnum, a rate) is a further table for M9: hours per
    resident day against that rate; without it M9 is left out."""
    fact, dim = spark.table(fact_table), spark.table(dim_table)
    by_type = {t[4:]: t for t in staffing.TOTAL_HOUR_COLUMNS}
    # the dimension has one row a provider, so months are summed first and the join sees the sums only
    months = serve.total_by(fact, ["provnum", "work_year", "work_month"], staffing.TOTAL_HOUR_COLUMNS)
    ratios = serve.load_ratio(fact, "provnum", staffing.TOTAL_HOUR_COLUMNS, F.sum("mdscensus"))
    official = dim.where(F.col("provider_match_status") == "matched")
    m9 = {} if readmissions is None else {"load_vs_readmission": serve.correlation(  # J6, M9
        ratios.join(readmissions.select("provnum", rate_col), "provnum"), "ratio", rate_col)}
    return m9 | {
        "occupancy": serve.occupancy(fact, "provnum", "mdscensus", dim, "number_of_certified_beds"),         # M7
        "reference_gap": serve.reference_gap(fact, "provnum", official, "provnum"),                   # M11
        "hours_by_type": serve.hours_by_type(fact, by_type),                                           # M1
        "emp_vs_ctr": serve.emp_vs_contract(fact, [], staffing.EMP_HOUR_COLUMNS,
                                            staffing.CTR_HOUR_COLUMNS),                                # M2
        "rating_in_out": serve.rating_by_flag(dim, "provnum", "provider_resides_in_hospital",
                                              "overall_rating"),                                       # M3 M4
        "total_by_provider": serve.total_by(fact, ["provnum"], staffing.TOTAL_HOUR_COLUMNS),           # M5
        "total_by_provider_state_month": serve.dashboard(months, dim, "provnum", {"state": "state"}),   # M6
        "lowest_staffed": serve.bottom_k(ratios, "ratio", ["provnum"], k),                             # M8
        "perm_vs_contract": serve.perm_vs_contract(fact, ["provnum"], staffing.EMP_HOUR_COLUMNS,
                                                   staffing.CTR_HOUR_COLUMNS, "mdscensus"),           # M10
    }

"""Driver queries: each operator of the inventory applied to the driver tables.

Every callable takes (spark, sf_dir) and returns a DataFrame over whole tables.
Timestamps stamped by a run are not part of the outputs (they are constants);
dates are cast explicitly. Names match the SQL oracle in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeq.contracts import ContractError, GateError, Lineage, TableContract, ValidationRules
from lakeq.functions.casts import lenient_double
from lakeq.functions.text import blank_to_null, clean_file_name, na_to_null, whitespace_to_null
from lakeq.operators import checks, comoments, curate, key_index, profile, profile_state, refine, serve, validate
from lakeq.operators.type_lattice import types_of
from lakeq.plans.discovery import read_for_profiling
from lakeq.plans.stages import Layout, run_stages
from lakeq.plans.tables import (
    customer_gaps,
    customer_tokens,
    events_gaps,
    lineitem_measures,
    lineitem_raw,
    lineitem_staged,
    load,
    orders_long_keys,
    orders_reference,
    part_by_encoding,
    part_odd_text,
    part_text,
    provider_raw,
    staffing_raw,
)
from lakeq.session import scratch_path
from lakeq.sources import ledger, snapshots
from lakeq.sources.csv import read_csv_by_file, read_csv_with_fallback
from lakeq.sources.manifest import last_entries, manifest_records, pending_files, write_manifest_document
from lakeq.sources.sinks import publish, read_run, write_partitioned, write_quarantine, write_run, write_table

RUN_ID = "r1"
RUN_TS = "2024-07-01 00:00:00"

# Contract of the landed lineitem text (standardised names -> types); the last
# entry is absent from the file on purpose (a warning, not an error).
LINEITEM_CONTRACT = TableContract(
    name="lineitem_raw",
    columns={
        "l_orderkey": "string",
        "l_partkey": "bigint",
        "l_suppkey": "int",
        "line_number": "int",
        "quantity": "decimal(10,2)",
        "extended_price": "decimal(10,2)",
        "discount": "decimal(10,2)",
        "tax": "decimal(4,2)",
        "return_flag": "string",
        "ship_date": "string",
        "commit_date": "string",
    },
    keys=("l_orderkey", "line_number"),
)

LINEITEM_RULES = ValidationRules(
    fact_keys=("l_orderkey", "l_linenumber"),
    ref_keys=("o_orderkey",),
    nonnegative=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    fact_ref_key="l_orderkey",
    ref_key="o_orderkey",
    fact_label="lineitem",
    ref_label="orders",
    measure_label="amounts",
)

GENERIC_FLAGS = ("match_status", "reference_source", "reference_gap_flag")
GENERIC_FLAG_VALUES = {
    "official": ("matched", "reference_file", "N"),
    "inferred": ("inferred_from_fact", "fact_file", "Y"),
}
HOURS = {"quantity": "l_quantity", "extended_price": "l_extendedprice", "discount": "l_discount",
         "tax": "l_tax"}
LANDED_ROWS = 500_000  # of a compressed text file
PROFILED = ("lineitem", "orders", "customer", "part", "supplier", "events")
DECLARED_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
    "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"], "documents": ["doc_id"],
    "labels": ["doc_id"], "pages": ["page_id"], "conversations": ["conv_id", "turn"],
}


def _dated(df: DataFrame) -> DataFrame:
    """Timestamp-without-zone columns as dates (the oracle does the same)."""
    return df.select([F.to_date(f.name).alias(f.name) if f.dataType.simpleString().startswith("timestamp")
                      else F.col(f.name) for f in df.schema.fields])


def _buckets(spark) -> int:
    """Buckets of written tables: one for each task of a shuffle, which then writes it alone."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _land_csv(df: DataFrame, path: str) -> None:
    """Text files with a header, compressed. A reader cannot split such a file, so none
    is longer than a task should read."""
    df.write.option("header", True).option("compression", "gzip").option("maxRecordsPerFile", LANDED_ROWS).csv(path)


def _union(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# ---- refine ---------------------------------------------------------------

def refine_typed(spark, sf):
    lineage = Lineage.fixed(RUN_ID, "lineitem", "lineitem.csv", RUN_TS)
    out = refine.refine(lineitem_raw(spark, sf), LINEITEM_CONTRACT, lineage).df
    return out.drop("ingest_ts_utc")


def cast_loss(spark, sf):
    return refine.cast_loss(lineitem_raw(spark, sf), LINEITEM_CONTRACT)


def contract_columns(spark, sf):
    """P5: the contract's columns against the landed file, which lacks one of them."""
    return refine.contract_report(lineitem_raw(spark, sf), LINEITEM_CONTRACT)


def run_stamps(spark, sf):
    """Rows of each run and file by the stamp of their run, read back from two runs."""
    path = scratch_path(spark, "stamped")
    for run, day in (("r1", "2024-07-01 00:00:00"), ("r2", "2024-07-02 06:30:00")):
        raw = lineitem_raw(spark, sf)
        if run == "r2":
            raw = raw.where(F.col("`Return Flag`") == "R")
        write_run(refine.refine(raw, LINEITEM_CONTRACT, Lineage.fixed(run, "lineitem", f"{run}.csv", day)).df, path, run)
    runs = reduce(DataFrame.unionByName, [read_run(spark, path, run) for run in ("r1", "r2")])
    return runs.groupBy("run_id", "dataset_name", "source_file_name",
                        F.date_format("ingest_ts_utc", "yyyy-MM-dd HH:mm:ss").alias("stamp")).agg(
        F.count(F.lit(1)).alias("row_count"))


def null_tokens(spark, sf):
    c = customer_tokens(spark, sf)
    t = F.col("segment_text")
    return c.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(blank_to_null(t).isNull()).alias("null_after_blank"),
        F.count_if(na_to_null(t).isNull()).alias("null_after_na_tokens"),
        F.count_if(whitespace_to_null(t).isNull()).alias("null_after_whitespace"),
        F.count_if(whitespace_to_null(na_to_null(t)).isNull()).alias("null_after_profile_read"))


# ---- validate -------------------------------------------------------------

def missing_key_rows(spark, sf):
    st = lineitem_staged(spark, sf)
    return st.where(validate.any_null(LINEITEM_RULES.fact_keys))


def negative_rows(spark, sf):
    def neg(table, key, cols):
        df = load(spark, sf, table)
        return df.where(validate.any_negative(df, cols)).select(
            F.lit(table).alias("table_name"), F.col(key).cast("bigint").alias("row_key"),
            F.col(cols[0]).alias("value"))
    return neg("customer", "c_custkey", ["c_acctbal"]).unionByName(neg("supplier", "s_suppkey", ["s_acctbal"]))


def duplicate_key_rows(spark, sf):
    li = _dated(load(spark, sf, "lineitem"))
    return checks.duplicate_key_rows(li, ["l_orderkey", "l_linenumber"], null_safe=False)


def duplicate_key_rows_nullsafe(spark, sf):
    return checks.duplicate_key_rows(lineitem_staged(spark, sf), ["l_orderkey", "l_linenumber"], null_safe=True)


def unmatched_rows(spark, sf):
    docs, labels = load(spark, sf, "documents"), load(spark, sf, "labels")
    return docs.join(labels.select("doc_id"), "doc_id", "left_anti")


def unreferenced_keys(spark, sf):
    orders = _dated(load(spark, sf, "orders"))
    keys = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return orders.join(keys, "o_orderkey", "left_anti")


def _tagged(spark, sf):
    fact, ref = lineitem_staged(spark, sf), orders_reference(spark, sf)
    return validate.tag_fact(fact, ref, LINEITEM_RULES), validate.tag_reference(ref, LINEITEM_RULES)


def validation_summary(spark, sf):
    tf, tr = _tagged(spark, sf)
    return validate.summary(tf, tr, LINEITEM_RULES)


def validation_gate(spark, sf):
    tf, tr = _tagged(spark, sf)
    return validate.gate(validate.counters(tf, tr, LINEITEM_RULES), LINEITEM_RULES)


def quarantine_rows(spark, sf):
    tf, tr = _tagged(spark, sf)
    return validate.quarantine_rows(tf, RUN_ID, RUN_TS).drop("quarantine_ts_utc")


def validation_run(spark, sf):
    """S10 + S11 + G3: the writing validation, whose summary is read back."""
    base = scratch_path(spark, "validation")
    validate.run_validation(lineitem_staged(spark, sf), orders_reference(spark, sf), LINEITEM_RULES, run_id=RUN_ID,
                            run_ts=RUN_TS, quarantine_base=f"{base}/quarantine", summary_path=f"{base}/summary",
                            raise_on_failure=False)
    return spark.read.parquet(f"{base}/summary")


def gate_outcomes(spark, sf):
    """How validation ends for the landed rows, the same without a key column,
    without rows, and for the rows that break no critical rule."""
    fact, ref = lineitem_staged(spark, sf), orders_reference(spark, sf)
    base, outcomes = scratch_path(spark, "gates"), []
    write_table(ref.where(F.col("o_orderkey").isNotNull()).dropDuplicates(["o_orderkey"]), f"{base}/reference")
    one_each = spark.read.schema(ref.schema).parquet(f"{base}/reference")

    def run(name: str, rows: DataFrame, reference: DataFrame, mode: str = "fail"):
        done, end, critical = None, "passed", None
        try:
            done = validate.run_validation(rows, reference, LINEITEM_RULES, run_id=name, run_ts=RUN_TS, mode=mode,
                                           quarantine_base=f"{base}/quarantine", summary_path=f"{base}/{name}")
        except (ContractError, GateError) as e:
            end = type(e).__name__
        if ledger.path_exists(spark, f"{base}/{name}"):
            critical = spark.read.parquet(f"{base}/{name}").where("severity = 'critical'").agg(
                F.sum("metric_value")).first()[0]
        outcomes.append((name, end, critical))
        return done
    run("landed", fact, ref)
    run("no_key_column", fact.drop("l_linenumber"), ref)
    run("no_rows", fact.where("l_quantity IS NULL AND l_quantity IS NOT NULL"), ref)
    run("clean", run("drop", fact, ref, "drop").clean, one_each)
    return spark.createDataFrame(outcomes, "scenario string, outcome string, critical_total bigint")


def stage_ledger(spark, sf):
    """Two runs of refine, validate, curate. The first has negative hours and ends at the
    gate; the second finishes. What each stage left, and whether the ledger has it as done."""
    base = scratch_path(spark, "stages")
    layout, provider = Layout(base), f"{base}/raw/provider"
    _land_csv(provider_raw(spark, sf), provider)
    reports = []
    for run, negative in (("r1", True), ("r2", False)):
        staffing = f"{base}/raw/{run}"
        _land_csv(staffing_raw(spark, sf, negative), staffing)
        entries = spark.createDataFrame([(run, "landing", d, path, path, path, 0, n) for n, (d, path) in enumerate(
            (("staffing_hours", staffing), ("provider_reference", provider)))],
            "run_id string, source string, dataset string, file_id string, file_name string, path string, "
            "size_bytes bigint, pos bigint")
        write_manifest_document(entries, f"{base}/manifest/{run}", RUN_TS)
        try:
            tables = run_stages(spark, f"{base}/manifest/{run}", layout, run, Lineage.fixed(run, "", "", RUN_TS).run_ts,
                                publish=False)["tables"]
        except GateError:
            tables = {}
        refined = {d: read_run(spark, layout.refined(d), run) for d in ("staffing_hours", "provider_reference")}
        curated = {t: spark.read.parquet(path) for t, path in tables.items()}
        reports += [df.agg(F.count(F.lit(1)).alias("value")).select(
            F.lit(run).alias("run_id"), F.lit(stage).alias("stage"), F.lit(f"{name}_rows").alias("metric"), "value")
            for stage, frames in (("refine", refined), ("curate", curated)) for name, df in frames.items()]
        reports.append(spark.read.parquet(layout.summary(run)).select(
            F.lit(run).alias("run_id"), F.lit("validate").alias("stage"), F.col("metric_name").alias("metric"),
            F.col("metric_value").alias("value")))
    done = ledger.read_stages(spark, layout.stages).withColumn("finished", F.lit(True))
    return reduce(DataFrame.unionByName, reports).join(done, ["run_id", "stage"], "left").withColumn(
        "finished", F.coalesce("finished", F.lit(False)))


# ---- curate ---------------------------------------------------------------

def _doc_dimension(spark, sf):
    # Every second key repeats, in the reference and in the fact.
    even = {"doc_id": F.col("doc_id") - F.col("doc_id") % 2}
    return curate.build_dimension(
        load(spark, sf, "labels").withColumns(even), load(spark, sf, "documents").withColumns(even),
        ref_key="doc_id", dim_key="doc_id", fact_key="doc_id",
        inferred_attrs={}, carried={"lang": "lang", "source": "source"},
        run_id=RUN_ID, run_ts=RUN_TS, flag_columns=GENERIC_FLAGS, flag_values=GENERIC_FLAG_VALUES)


def dim_with_inferred(spark, sf):
    return _doc_dimension(spark, sf).drop("curated_ts_utc")


def dim_drops_unreferenced(spark, sf):
    dim = curate.build_dimension(
        load(spark, sf, "customer"), load(spark, sf, "events"),
        ref_key="c_custkey", dim_key="customer_key", fact_key="user_id",
        inferred_attrs={}, carried={"event_type": "first_event_type"},
        run_id=RUN_ID, run_ts=RUN_TS, flag_columns=GENERIC_FLAGS, flag_values=GENERIC_FLAG_VALUES)
    return dim.drop("curated_ts_utc")


def _fact_daily(spark, sf):
    """Events by day; some days are no dates."""
    ev = load(spark, sf, "events").withColumn("workdate", F.when(F.col("event_id") % 17 == 0, F.lit("20241399"))
                                              .otherwise(F.date_format("ts", "yyyyMMdd")))
    out = curate.build_fact(ev, date_col="workdate", drop=("workdate", "ts", "props"),
                            run_id=RUN_ID, run_ts=RUN_TS)
    return out.drop("curated_ts_utc")


def fact_daily(spark, sf):
    return _fact_daily(spark, sf)


def bad_dates(spark, sf):
    return curate.bad_date_count(_fact_daily(spark, sf))


def published_fact(spark, sf):
    """S8 + S12 + S13: the fact written by month, published, and read by its name."""
    path = scratch_path(spark, "published")
    write_partitioned(_fact_daily(spark, sf), path, ("work_year", "work_month"))
    table = publish(spark, "lakeq_fact_daily", path, RUN_ID, partition_cols=("work_year", "work_month"),
                    attempt=path.rsplit("-", 1)[-1])
    return spark.table(table).withColumns({c: F.col(c).cast("int") for c in ("work_year", "work_month")})


# ---- serve ----------------------------------------------------------------

def dashboard_join(spark, sf):
    orders = _dated(load(spark, sf, "orders"))
    dim = load(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return serve.dashboard(orders, dim, "o_custkey",
                           {"cust_nation": "c_nationkey", "cust_segment": "c_mktsegment",
                            "cust_balance": "c_acctbal"})


DOC_FACT_VIEW = [("doc_id", "bigint"), ("lang", "string"), ("n_chars", "decimal(10,2)"),
                 ("match_status", "string"), ("reference_source", "string"), ("reference_gap_flag", "string"),
                 ("run_id", "string")]


def fact_view_flags(spark, sf):
    """Documents served under a declared view, with the match flags of
    the curated dimension joined in and n_chars served as a decimal."""
    docs = load(spark, sf, "documents").withColumn("run_id", F.lit(RUN_ID))
    return serve.fact_view(docs, _doc_dimension(spark, sf), "doc_id", GENERIC_FLAGS, DOC_FACT_VIEW)


def _served_orders(spark, sf):
    """Orders by month and customers, written in equal buckets and taken from one commit."""
    orders = _dated(load(spark, sf, "orders")).withColumns({
        "o_totalprice": F.col("o_totalprice").cast("decimal(12,2)"),
        "order_year": F.year("o_orderdate"), "order_month": F.month("o_orderdate")})
    customers = load(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    path = scratch_path(spark, "serving")
    attempt = snapshots.write_serving(
        orders, customers, key="o_custkey", fact_name="lakeq_orders", dim_name="lakeq_customers", base=path,
        attempt=path.rsplit("-", 1)[-1], buckets=_buckets(spark), partition_cols=("order_year",))
    snapshots.commit(spark, "lakeq_serving", attempt)
    served = snapshots.open_snapshot(spark, "lakeq_serving")
    return snapshots.dashboard(served["lakeq_orders"], served["lakeq_customers"], "o_custkey",
                               {"cust_nation": "c_nationkey", "cust_segment": "c_mktsegment", "cust_balance": "c_acctbal"})


def snapshot_dashboard(spark, sf):
    """J5 + S12 + S13: the dashboard join over one commit of two bucketed tables."""
    return _served_orders(spark, sf)


def snapshot_total_by_customer_month(spark, sf):
    """M5 + M6 over the same commit."""
    return serve.total_by(_served_orders(spark, sf), ["o_custkey", "cust_nation", "order_year", "order_month"],
                          ["o_totalprice"])


def _rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def hours_by_type(spark, sf):
    return serve.hours_by_type(lineitem_measures(spark, sf), HOURS)


def emp_vs_ctr(spark, sf):
    return serve.emp_vs_contract(lineitem_measures(spark, sf), ["l_returnflag"],
                                 ["l_quantity", "l_extendedprice"], ["l_discount", "l_tax"])


def rating_in_out(spark, sf):
    return _rounded(serve.rating_by_flag(_doc_dimension(spark, sf), "doc_id", "toxic", "quality"), 6, "avg_rating")


def total_by_provider(spark, sf):
    return serve.total_by(lineitem_measures(spark, sf), ["l_suppkey"], list(HOURS.values()))


def total_by_provider_state_month(spark, sf):
    li = lineitem_measures(spark, sf).withColumns({"work_year": F.year("l_shipdate"), "work_month": F.month("l_shipdate")})
    sup = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nat = load(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"),
                                            F.col("n_name").alias("state"))
    # the provider is the join key, so totals by provider come first and the join sees those only
    totals = serve.total_by(li, ["l_suppkey", "work_year", "work_month"], list(HOURS.values()))
    return totals.join(sup, "l_suppkey").join(nat, "s_nationkey").drop("s_nationkey")


def _load_ratios(spark, sf):
    return serve.load_ratio(lineitem_measures(spark, sf), "l_suppkey", ["l_discount"], F.count_distinct("l_orderkey"))


def load_ratio_bottom_k(spark, sf):
    """Ratios of a few hundred-thousandths, which differ in the seventh decimal."""
    return _rounded(serve.bottom_k(_load_ratios(spark, sf), "ratio", ["l_suppkey"], 10), 12, "ratio")


def occupancy_by_provider(spark, sf):
    beds = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    out = serve.occupancy(lineitem_measures(spark, sf), "l_suppkey", "l_quantity", beds, "s_nationkey")
    return _rounded(out, 6, "avg_census", "occupancy")


def _with_balance(spark, sf, df):
    return df.join(load(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_acctbal"), "l_suppkey")


def corr_measures(spark, sf):
    totals = serve.total_by(lineitem_measures(spark, sf), ["l_suppkey"], ["l_quantity"])
    return _rounded(serve.correlation(_with_balance(spark, sf, totals), "total_hours", "s_acctbal"), 9, "correlation")


def corr_load_ratio(spark, sf):
    pairs = _with_balance(spark, sf, _load_ratios(spark, sf))
    return _rounded(serve.correlation(pairs, "ratio", "s_acctbal"), 9, "correlation")


def correlation_matrix(spark, sf):
    """J6 + M9: correlations of all pairs of a supplier's measures, from three runs' states."""
    totals = lineitem_measures(spark, sf).groupBy("l_suppkey").agg(*[
        F.sum(c).cast("double").alias(name) for name, c in HOURS.items()])
    aligned = _with_balance(spark, sf, totals)
    path = scratch_path(spark, "pair-state")
    for i in range(3):
        run = aligned.where(F.col("l_suppkey") % 3 == i)
        write_run(comoments.pair_state(run, [*HOURS, "s_acctbal"]), path, f"r{i}")
    return _rounded(comoments.correlations(comoments.merge_states(spark.read.parquet(path))), 9, "correlation")


def perm_vs_contract(spark, sf):
    out = serve.perm_vs_contract(lineitem_measures(spark, sf), ["l_linestatus"],
                                 ["l_extendedprice"], ["l_discount"], "l_quantity")
    return _rounded(out, 6, "emp_ctr_ratio", "emp_per_load", "ctr_per_load")


def reference_gap(spark, sf):
    return serve.reference_gap(load(spark, sf, "documents"), "doc_id", load(spark, sf, "labels"), "doc_id")


def duplicates_across_runs(spark, sf):
    """F3 + J1 over runs: each run's rows whose key repeats in it or in an earlier run; a
    run is added to the index after its check."""
    staged, path = lineitem_staged(spark, sf), scratch_path(spark, "key-index")
    index = f"lakeq_keys_{path.rsplit('-', 1)[-1]}"
    key_index.create_key_index(spark, index, f"{path}/index", {"l_orderkey": "bigint", "l_linenumber": "int"},
                               _buckets(spark))
    for i in range(3):
        run = staged.where(F.col("l_suppkey") % 3 == i)
        write_run(key_index.duplicates_against_history(run, index, f"r{i}"), f"{path}/found", f"r{i}")
        key_index.add_run(run, index, f"r{i}")
    return spark.read.parquet(f"{path}/found")


# ---- lake I/O ---------------------------------------------------------------

def partition_roundtrip(spark, sf):
    li = _dated(load(spark, sf, "lineitem")).withColumnRenamed("l_shipdate", "ship_date")
    li = li.withColumns({"ship_year": F.year("ship_date"), "ship_month": F.month("ship_date")})
    path = scratch_path(spark, "partition_roundtrip")
    write_partitioned(li, path, ("ship_year", "ship_month"))
    return spark.read.schema(li.schema).parquet(path)


def refined_run_roundtrip(spark, sf):
    """S7 + S3: refined rows written to a run directory and read back by run."""
    base = scratch_path(spark, "refined")
    write_run(refine_typed(spark, sf), base, RUN_ID)
    return read_run(spark, base, RUN_ID)


def quarantine_roundtrip(spark, sf):
    """Quarantined fact rows written partitioned by reason and read back;
    the reason comes from the directory, as text (trap T15)."""
    tf, _ = _tagged(spark, sf)
    base = scratch_path(spark, "quarantine")
    path = write_quarantine(validate.quarantine_rows(tf, RUN_ID, RUN_TS), base, "lineitem", RUN_ID)
    return spark.read.parquet(path).drop("quarantine_ts_utc")


def quarantine_reference_roundtrip(spark, sf):
    """The reference's quarantined rows, written and read back."""
    _, tr = _tagged(spark, sf)
    path = write_quarantine(validate.quarantine_rows(tr, RUN_ID, RUN_TS), scratch_path(spark, "quarantine"), "orders",
                            RUN_ID)
    return spark.read.parquet(path).drop("quarantine_ts_utc")


def _written_csv(spark, df, name):
    path = scratch_path(spark, name)
    (df.write.option("header", True).option("quoteAll", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def csv_roundtrip(spark, sf):
    """S1 + S2: a table with quotes, line breaks and non-ASCII text, as CSV and back."""
    return read_csv_with_fallback(spark, _written_csv(spark, part_odd_text(spark, sf), "parts"), multi_line=True)[0]


def csv_mixed_encodings(spark, sf):
    """Files of three encodings in one folder, each decoded by its own."""
    path = scratch_path(spark, "mixed")
    parts = part_by_encoding(spark, sf)
    # The byte of the euro sign in Windows-1252 is that of U+0080 in Latin-1.
    as_cp1252 = F.translate("p_name", "\u20ac", "\u0080")
    for i, (encoding, name) in enumerate((("UTF-8", F.col("p_name")), ("ISO-8859-1", as_cp1252), ("ISO-8859-1", F.col("p_name")))):
        (parts.where(F.col("p_partkey").cast("long") % 3 == i).withColumn("p_name", name).write.mode("append")
         .option("header", True).option("quoteAll", True).option("encoding", encoding).csv(path))
    return read_csv_by_file(spark, path).select("p_partkey", "p_name", F.col("source_encoding").alias("encoding"))


def merged_profile(spark, sf):
    """C5 + A6-A8 + P22: the profile of three runs from their stored states alone."""
    raw = profile.profile_read(lineitem_raw(spark, sf))
    path = scratch_path(spark, "profile-state")
    for i in range(3):
        run = raw.where(F.col("` L OrderKey `").cast("long") % 3 == i)
        profile_state.run_state(run, f"r{i}").write.parquet(f"{path}/state/run_id=r{i}")
        state = spark.read.parquet(f"{path}/state/run_id=r{i}")
        profile_state.run_values(run, state, f"r{i}").write.mode("append").parquet(f"{path}/values")
    states = spark.read.parquet(f"{path}/state/run_id=r0", f"{path}/state/run_id=r1", f"{path}/state/run_id=r2")
    merged = profile_state.merge_states(states)
    whole = profile_state.merge_values(states, spark.read.parquet(f"{path}/values"))
    return profile_state.profile_of(merged, whole).join(types_of(merged), "column_name").select(
        "column_name", "runs", "total_rows", "missing_count", "missing_percent", "distinct_values", "most_frequent_count",
        "inferred_type")


def date_gaps_by_customer(spark, sf):
    """The runs of days on which a customer ordered nothing."""
    return checks.date_gaps(load(spark, sf, "orders"), "o_orderdate", by=["o_custkey"])


def missing_dates_by_priority(spark, sf):
    """Each priority's days without an order."""
    return checks.missing_dates(load(spark, sf, "orders"), "o_orderdate", by=["o_orderpriority"])


def csv_profile(spark, sf):
    """S2 + P15 + P16 + P22 over a CSV file: missing values of each typed column."""
    typed, _, types = read_for_profiling(spark, _written_csv(spark, lineitem_raw(spark, sf), "lineitem"))
    kinds = spark.createDataFrame(sorted(types.items()), "column_name string, inferred_type string")
    return profile.missing_counts(typed, "lineitem").join(kinds, "column_name")


def dimension_roundtrip(spark, sf):
    """The curated dimension written unpartitioned and read back."""
    path = scratch_path(spark, "dimension")
    write_table(_doc_dimension(spark, sf), path)
    return spark.read.parquet(path).drop("curated_ts_utc")


def _page_manifest(pages: DataFrame, run_id: str, pos: str | None = None) -> DataFrame:
    host = F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#:]+)", 1)
    url_path = F.regexp_extract("url", r"^[a-zA-Z]+://[^/?#]*(/[^?#]*)?", 1)
    name = F.regexp_extract(url_path, r"([^/]*)$", 1)
    return manifest_records(pages, run_id=run_id, dataset=host, file_id="page_id", file_name=name,
                            path="url", size_bytes=F.octet_length("html"), source="web", pos=pos)


def manifest_pending(spark, sf):
    pages = load(spark, sf, "pages")
    processed = _page_manifest(pages.where(F.col("url").startswith("https://")), "r1")
    return pending_files(_page_manifest(pages, "r2"), processed)


def files_by_content(spark, sf):
    """Five landed files, published by a run; of the next run's files some have other
    content of the same size, the rest the same lines in other files."""
    path = scratch_path(spark, "landed")
    lines = load(spark, sf, "part").select(
        "p_partkey", "p_name", F.concat(F.lit("b"), F.col("p_partkey") % 5).alias("dataset"))

    def landed(run: str, name) -> DataFrame:
        lines.select("dataset", F.concat_ws(",", "p_partkey", name)).repartition(5, "dataset").write.partitionBy(
            "dataset").text(f"{path}/{run}")
        return ledger.file_digests(spark, f"{path}/{run}").withColumn("dataset", F.regexp_extract("path", "dataset=([^/]+)", 1))
    first = landed("r1", F.col("p_name")).withColumns({
        "refined_run": F.lit("r1"), "at": F.lit(RUN_TS).cast("timestamp")})
    ledger.record_files(first, f"{path}/ledger", "r1", "published")
    second = landed("r2", F.when(F.col("p_partkey") % 5 % 2 == 1, F.translate("p_name", "e", "o")).otherwise(F.col("p_name")))
    return ledger.known_files(second, ledger.read_files(spark, f"{path}/ledger")).select(
        "dataset", "lines", "size_bytes", "known_run")


def manifest_last_entries(spark, sf):
    """Of each host's entries, the last one."""
    entries = _page_manifest(load(spark, sf, "pages"), "r2", pos="page_id")
    return last_entries(entries).select("dataset", "file_id", "file_name", "path", "size_bytes", "pos")


def clean_file_names(spark, sf):
    p = load(spark, sf, "part")
    raw = F.concat(F.lit(" "), F.col("p_brand"), F.lit("/"), F.col("p_name"), F.lit("\\x "))
    return p.select("p_partkey", raw.alias("raw_name"), clean_file_name(raw).alias("file_name"))


# ---- profile / checks ---------------------------------------------------------

def profile_columns(spark, sf):
    return _union([profile.column_profile(events_gaps(spark, sf) if t == "events" else load(spark, sf, t), t)
                   for t in PROFILED])


def column_catalog(spark, sf):
    """The catalog of the tables, with the values that each column really holds."""
    def counted(table: str) -> DataFrame:
        df = load(spark, sf, table)
        present = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)]).select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("non_null_count")) for i, c in enumerate(df.columns)])))
        return profile.column_catalog(df, table).join(F.broadcast(present), "column_name")  # one row a column
    return _union([counted(t) for t in PROFILED]).select("table_name", "column_name", "dtype", "non_null_count")


def inferred_long_keys(spark, sf):
    """Keys of 19 and 21 digits keep every digit when the types are applied."""
    text = orders_long_keys(spark, sf)
    types = {r.column_name: r.inferred_type for r in profile.infer_types(text).collect()}
    return profile.apply_inferred_types(text, types)


def typed_numbers(spark, sf):
    p = part_text(spark, sf)
    return p.select("p_partkey", lenient_double("p_size_text").alias("p_size"),
                    lenient_double("p_retailprice_text").alias("p_retailprice"))


def inferred_types(spark, sf):
    return profile.infer_types(profile.profile_read(lineitem_raw(spark, sf)))


def missing_ranking(spark, sf):
    counts = profile.missing_counts(profile.profile_read(lineitem_raw(spark, sf)), "lineitem_raw")
    return profile.missing_ranking(counts)


def dataset_overview(spark, sf):
    return _union([profile.dataset_overview(load(spark, sf, t), t) for t in PROFILED])


def duplicate_full_rows(spark, sf):
    ev = load(spark, sf, "events").select("user_id", F.to_date("ts").alias("event_date"), "event_type")
    return profile.duplicate_groups(ev, ["user_id", "event_date", "event_type"])


def duplicate_text(spark, sf):
    return profile.duplicate_rows(load(spark, sf, "documents").select("text"), "documents.text")


LINEITEM_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax"]


def numeric_summary(spark, sf):
    return profile.numeric_summary(load(spark, sf, "lineitem"), LINEITEM_NUMBERS, "lineitem", digits=6).unionByName(
        profile.numeric_summary(events_gaps(spark, sf), ["value", "user_id"], "events", digits=6))


def iqr_outliers(spark, sf):
    return profile.iqr_outliers(events_gaps(spark, sf), ["value", "user_id"], "events").unionByName(
        profile.iqr_outliers(load(spark, sf, "lineitem"), LINEITEM_NUMBERS, "lineitem"))


def numeric_like_text(spark, sf):
    parts = profile.numeric_like_text(part_text(spark, sf),
                                      ["p_name", "p_brand", "p_size_text", "p_retailprice_text"])
    props = profile.numeric_like_text(load(spark, sf, "events"), ["event_type", "props"])
    return (parts.select(F.lit("part").alias("table_name"), "*")
            .unionByName(props.select(F.lit("events").alias("table_name"), "*")))


def range_violations(spark, sf):
    return checks.range_violations(customer_gaps(spark, sf), "c_acctbal", 0, 9000)


def missing_dates(spark, sf):
    return checks.missing_dates(load(spark, sf, "orders"), "o_orderdate")


def file_bounds(spark, sf):
    """A13 + A18: rows and bounds of written orders, from the footers of their files."""
    orders = _dated(load(spark, sf, "orders")).select("o_orderkey", "o_custkey", "o_orderdate")
    path = write_run(orders, scratch_path(spark, "bounds"), RUN_ID)
    return checks.file_bounds(spark, path, ["o_orderkey", "o_custkey", "o_orderdate"])


def date_range(spark, sf):
    return checks.date_bounds(load(spark, sf, "orders"), "o_orderdate")


def key_uniqueness_report(spark, sf):
    return checks.key_reports({t: (load(spark, sf, t), k) for t, k in DECLARED_KEYS.items()})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "refine_typed": refine_typed,
    "cast_loss": cast_loss,
    "null_tokens": null_tokens,
    "missing_key_rows": missing_key_rows,
    "negative_rows": negative_rows,
    "duplicate_key_rows": duplicate_key_rows,
    "duplicate_key_rows_nullsafe": duplicate_key_rows_nullsafe,
    "unmatched_rows": unmatched_rows,
    "unreferenced_keys": unreferenced_keys,
    "validation_summary": validation_summary,
    "validation_gate": validation_gate,
    "quarantine_rows": quarantine_rows,
    "dim_with_inferred": dim_with_inferred,
    "dim_drops_unreferenced": dim_drops_unreferenced,
    "fact_daily": fact_daily,
    "dashboard_join": dashboard_join,
    "partition_roundtrip": partition_roundtrip,
    "refined_run_roundtrip": refined_run_roundtrip,
    "quarantine_roundtrip": quarantine_roundtrip,
    "dimension_roundtrip": dimension_roundtrip,
    "profile_columns": profile_columns,
    "dataset_overview": dataset_overview,
    "inferred_types": inferred_types,
    "missing_ranking": missing_ranking,
    "duplicate_full_rows": duplicate_full_rows,
    "duplicate_text": duplicate_text,
    "numeric_summary": numeric_summary,
    "iqr_outliers": iqr_outliers,
    "numeric_like_text": numeric_like_text,
    "range_violations": range_violations,
    "missing_dates": missing_dates,
    "date_range": date_range,
    "key_uniqueness_report": key_uniqueness_report,
    "fact_view_flags": fact_view_flags,
    "hours_by_type": hours_by_type,
    "emp_vs_ctr": emp_vs_ctr,
    "rating_in_out": rating_in_out,
    "total_by_provider": total_by_provider,
    "total_by_provider_state_month": total_by_provider_state_month,
    "load_ratio_bottom_k": load_ratio_bottom_k,
    "corr_measures": corr_measures,
    "corr_load_ratio": corr_load_ratio,
    "occupancy_by_provider": occupancy_by_provider,
    "validation_run": validation_run,
    "quarantine_reference_roundtrip": quarantine_reference_roundtrip,
    "bad_dates": bad_dates,
    "published_fact": published_fact,
    "csv_roundtrip": csv_roundtrip,
    "csv_profile": csv_profile,
    "csv_mixed_encodings": csv_mixed_encodings,
    "merged_profile": merged_profile,
    "date_gaps_by_customer": date_gaps_by_customer,
    "missing_dates_by_priority": missing_dates_by_priority,
    "column_catalog": column_catalog,
    "inferred_long_keys": inferred_long_keys,
    "typed_numbers": typed_numbers,
    "manifest_last_entries": manifest_last_entries,
    "perm_vs_contract": perm_vs_contract,
    "reference_gap": reference_gap,
    "manifest_pending": manifest_pending,
    "clean_file_name": clean_file_names,
    "duplicates_across_runs": duplicates_across_runs,
    "snapshot_dashboard": snapshot_dashboard,
    "snapshot_total_by_customer_month": snapshot_total_by_customer_month,
    "correlation_matrix": correlation_matrix,
    "files_by_content": files_by_content,
    "file_bounds": file_bounds,
    "contract_columns": contract_columns,
    "run_stamps": run_stamps,
    "gate_outcomes": gate_outcomes,
    "stage_ledger": stage_ledger,
}

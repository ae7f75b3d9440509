"""C2 validate: key, duplicate, range and reference rules in one pass.

Plan shape: where the reference key is one of the fact's keys, the rows are dealt by
it, and both the copies of a key (a window) and the reference (a join) need no other
shuffle, so the wide fact is shuffled once and its keys only for the hot ones among
them. Rows of hot reference keys take another way: the copies of each key come from a
map-side-combined aggregate, the reference is looked up once per key, and the rows are
joined with that thin table without meeting in one task (``joins.split_join``). All
counters come from one aggregate of the tagged rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeq.contracts import ContractError, GateError, ValidationRules
from lakeq.functions.names import quoted
from lakeq.operators.joins import DEFAULT_TARGET_ROWS, hot_keys, key_counts, split_join
from lakeq.session import scratch_path

_MISSING = "__lq_missing"
_DUP = "__lq_dup_n"
_NEG = "__lq_negative"
_UNMATCHED = "__lq_unmatched"
REASONS = "quarantine_reasons"


def check_contract(tables: dict[str, tuple[DataFrame, tuple[str, ...]]]) -> None:
    """G1: schema-only check of {label: (frame, required columns)}, before any job.
    All that is missing, from all tables, is reported together."""
    gaps = {label: sorted(set(required) - set(df.columns)) for label, (df, required) in tables.items()}
    gaps = {label: names for label, names in gaps.items() if names}
    if gaps:
        raise ContractError("contract not met: " + "; ".join(f"{label} lacks {', '.join(n)}" for label, n in gaps.items()))


def any_null(keys) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def any_negative(df: DataFrame, columns) -> Column:
    """OR of ``c < 0`` over the listed columns that exist; NULL is not negative."""
    present = [c for c in columns if c in df.columns]
    if not present:
        raise ContractError(f"none of the range-rule columns {list(columns)} exist")
    return F.coalesce(reduce(lambda a, b: a | b, [F.col(c) < 0 for c in present]), F.lit(False))


def complete(keys) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def with_duplicate_count(df: DataFrame, keys, name: str = _DUP,
                         target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """F3 + J1: attach the copy count of each row's key when the key repeats.

    Keys with a NULL part never count (SQL semantics, trap T7)."""
    counts = key_counts(df, keys)
    dups = counts.where(complete(keys) & (F.col("__lq_n") > 1)).withColumnRenamed("__lq_n", name)
    return split_join(df, dups, keys, "left", counts=counts, target_rows=target_rows)


def with_reference_match(df: DataFrame, fact_key: str, ref: DataFrame, ref_key: str,
                         name: str = _UNMATCHED, counts: DataFrame | None = None,
                         target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Flag rows whose key has no reference row (a NULL key never matches).
    The reference keys are made unique, so rows are not multiplied."""
    keys = (ref.select(F.col(ref_key).alias(fact_key)).where(F.col(fact_key).isNotNull()).distinct()
            .withColumn("__lq_hit", F.lit(True)))
    joined = split_join(df, keys, [fact_key], "left", counts=counts, target_rows=target_rows)
    return joined.withColumn(name, F.col("__lq_hit").isNull()).drop("__lq_hit")


def _copies(keys, n: Column) -> Column:
    """How often a complete key occurs, if more than once."""
    return F.when(complete(keys) & (n > 1), n)


def _lookup_by_key(fact: DataFrame, ref: DataFrame, rules: ValidationRules, target_rows: int) -> DataFrame:
    """Copies and reference match of rows of any skew: the reference is looked up once
    per key, and the rows are joined once."""
    keys = list(rules.fact_keys)
    counts = key_counts(fact, keys)
    per_key = with_reference_match(counts, rules.fact_ref_key, ref, rules.ref_key, target_rows=target_rows)
    return split_join(fact, per_key.withColumn(_DUP, _copies(keys, F.col("__lq_n"))).drop("__lq_n"), keys, "left",
                      counts=counts, target_rows=target_rows)


def _lookup(fact: DataFrame, ref: DataFrame, rules: ValidationRules, target_rows: int) -> DataFrame:
    """Copies and reference match with one shuffle of the rows, by the reference key; rows
    whose reference key has more than ``target_rows`` of them go by ``_lookup_by_key``."""
    key, keys, rows = rules.fact_ref_key, list(rules.fact_keys), [F.col(quoted(c)) for c in fact.columns]
    hot = hot_keys(key_counts(fact, [key]), [key], target_rows).select(
        F.col(key).alias("__lq_h0"), F.lit(True).alias("__lq_hot"))
    marked = fact.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("__lq_h0")), "left")
    few = marked.where(F.col("__lq_hot").isNull()).select(*rows).repartition(key).withColumn(
        _DUP, _copies(keys, F.count(F.lit(1)).over(W.partitionBy(*keys))))
    known = ref.select(F.col(rules.ref_key).alias("__lq_s0")).where(F.col("__lq_s0").isNotNull()).distinct().withColumn(
        "__lq_hit", F.lit(True))
    few = few.join(known, F.col(key) == F.col("__lq_s0"), "left").select(
        *rows, _DUP, F.col("__lq_hit").isNull().alias(_UNMATCHED))
    many = _lookup_by_key(marked.where(F.col("__lq_hot")).select(*rows), ref, rules, target_rows)
    return few.unionByName(many)


def _reasons(pairs) -> Column:
    arr = F.array(*[F.when(flag, F.lit(reason)) for flag, reason in pairs])
    return F.filter(arr, lambda x: x.isNotNull())


def tag_fact(fact: DataFrame, ref: DataFrame, rules: ValidationRules,
             target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Fact rows + rule flags + ``quarantine_reasons`` (array, possibly empty)."""
    check_contract({f"{rules.fact_label} data": (fact, rules.fact_keys), f"{rules.ref_label} data": (ref, rules.ref_keys)})
    negative = any_negative(fact, rules.nonnegative)
    keys = list(rules.fact_keys)
    if rules.fact_ref_key in keys:
        tagged = _lookup(fact, ref, rules, target_rows)
    else:
        tagged = with_duplicate_count(fact, keys, target_rows=target_rows)
        tagged = with_reference_match(tagged, rules.fact_ref_key, ref, rules.ref_key, target_rows=target_rows)
    tagged = tagged.withColumns({_MISSING: any_null(keys), _NEG: negative}).withColumn(REASONS, _reasons([
        (F.col(_MISSING), rules.reason("fact_missing")),
        (F.col(_DUP).isNotNull(), rules.reason("fact_duplicate")),
        (F.col(_NEG), rules.reason("negative")),
        (F.col(_UNMATCHED), rules.reason("unmatched")),
    ]))
    return tagged.select(*fact.columns, _MISSING, _DUP, _NEG, _UNMATCHED, REASONS)


def tag_reference(ref: DataFrame, rules: ValidationRules, target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    check_contract({f"{rules.ref_label} data": (ref, rules.ref_keys)})
    tagged = with_duplicate_count(ref, rules.ref_keys, target_rows=target_rows).withColumn(
        _MISSING, any_null(rules.ref_keys))
    tagged = tagged.withColumn(REASONS, _reasons([
        (F.col(_MISSING), rules.reason("ref_missing")),
        (F.col(_DUP).isNotNull(), rules.reason("ref_duplicate")),
    ]))
    return tagged.select(*ref.columns, _MISSING, _DUP, REASONS)


def _fact_counters(rules: ValidationRules):
    critical = F.col(_MISSING) | F.col(_DUP).isNotNull() | F.col(_NEG)
    fl = rules.fact_label
    return [
        F.count(F.lit(1)).alias(f"{fl}_row_count"),
        F.count_if(F.col(_MISSING)).alias(f"bad_{fl}_required_count"),
        F.count_if(F.col(_DUP).isNotNull()).alias(f"{fl}_duplicate_count"),
        F.count_if(F.col(_NEG)).alias(f"negative_{rules.measure_label}_count"),
        F.count_if(F.col(_UNMATCHED)).alias(f"unmatched_{fl}_count"),
        F.count_if(critical).alias(f"{fl}_bad_rows"),
    ]


def _ref_counters(rules: ValidationRules):
    rl = rules.ref_label
    return [
        F.count(F.lit(1)).alias(f"{rl}_row_count"),
        F.count_if(F.col(_MISSING)).alias(f"bad_{rl}_required_count"),
        F.count_if(F.col(_DUP).isNotNull()).alias(f"{rl}_duplicate_count"),
        F.count_if(F.col(_MISSING) | F.col(_DUP).isNotNull()).alias(f"{rl}_bad_rows"),
    ]


def summary_layout(rules: ValidationRules) -> list[tuple[str, str]]:
    """The eight summary metrics, in order, with their severity.
    Fixed values: metric names and severities."""
    fl, rl = rules.fact_label, rules.ref_label
    return [
        (f"{fl}_row_count", "info"),
        (f"{rl}_row_count", "info"),
        (f"bad_{fl}_required_count", "critical"),
        (f"bad_{rl}_required_count", "critical"),
        (f"{fl}_duplicate_count", "critical"),
        (f"{rl}_duplicate_count", "critical"),
        (f"negative_{rules.measure_label}_count", "critical"),
        (f"unmatched_{fl}_count", "warning"),
    ]


def _long(wide: DataFrame, layout) -> DataFrame:
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric_name"), F.col(m).cast("bigint").alias("metric_value"),
                 F.lit(s).alias("severity"))
        for m, s in layout
    ])))


def counters(tagged_fact: DataFrame, tagged_ref: DataFrame, rules: ValidationRules) -> DataFrame:
    """All counters of both tables as (metric_name, metric_value, severity) rows.

    Two one-row aggregates stacked by a union; no cross join."""
    fact_wide = tagged_fact.agg(*_fact_counters(rules))
    ref_wide = tagged_ref.agg(*_ref_counters(rules))
    layout = dict(summary_layout(rules))
    fact_names = [c for c in fact_wide.columns]
    ref_names = [c for c in ref_wide.columns]
    return _long(fact_wide, [(m, layout.get(m, "extra")) for m in fact_names]).unionByName(
        _long(ref_wide, [(m, layout.get(m, "extra")) for m in ref_names]))


def summary(tagged_fact: DataFrame, tagged_ref: DataFrame, rules: ValidationRules) -> DataFrame:
    """S11 content: the eight parity rows (metric_name, metric_value, severity)."""
    names = [m for m, _ in summary_layout(rules)]
    return counters(tagged_fact, tagged_ref, rules).where(F.col("metric_name").isin(names))


def gate(counter_rows: DataFrame, rules: ValidationRules) -> DataFrame:
    """A16 + G3: one row with the critical sum (a row breaking two rules counts
    twice, trap T17), the distinct bad rows, and whether the gate passes."""
    fl, rl = rules.fact_label, rules.ref_label
    return counter_rows.agg(
        F.sum(F.when(F.col("severity") == "critical", F.col("metric_value")).otherwise(0))
        .cast("bigint").alias("critical_total"),
        F.sum(F.when(F.col("metric_name").isin(f"{fl}_bad_rows", f"{rl}_bad_rows"),
                     F.col("metric_value")).otherwise(0)).cast("bigint").alias("distinct_bad_rows"),
        F.sum(F.when(F.col("severity") == "warning", F.col("metric_value")).otherwise(0))
        .cast("bigint").alias("warning_total"),
    ).withColumn("passed", F.col("critical_total") == 0)


def clean_rows(tagged_fact: DataFrame) -> DataFrame:
    """T18 option ``mode='drop'``: the fact rows that break no critical rule
    (rows carrying only the unmatched-reference warning stay), source columns only."""
    source = [c for c in tagged_fact.columns if not c.startswith("__lq_") and c != REASONS]
    ok = ~F.col(_MISSING) & F.col(_DUP).isNull() & ~F.col(_NEG)
    return tagged_fact.where(ok).select(*source)


def quarantine_rows(tagged: DataFrame, run_id: str, run_ts) -> DataFrame:
    """S10 content: one row per (source row, reason), source columns kept."""
    source = [c for c in tagged.columns if not c.startswith("__lq_") and c != REASONS]
    return (tagged.where(F.size(REASONS) > 0)
            .select(*source, F.explode(REASONS).alias("quarantine_reason"))
            .withColumn("run_id", F.lit(run_id))
            .withColumn("quarantine_ts_utc", F.lit(run_ts).cast("timestamp")))


@dataclass
class ValidationOutcome:
    summary: DataFrame
    counters: dict
    critical_total: int
    passed: bool
    clean: DataFrame | None = None  # mode='drop': fact rows that break no critical rule


def run_validation(fact: DataFrame, ref: DataFrame, rules: ValidationRules, *, run_id: str,
                   run_ts, quarantine_base: str, summary_path: str,
                   raise_on_failure: bool = True, mode: str = "fail") -> ValidationOutcome:
    """C2 with its writes: quarantine (per table, partitioned by reason, the run's
    directory always overwritten — trap T16), then the summary, then the gate.

    The rules are evaluated once a table: the rows that break one, with their flags, are
    written to the scratch folder (with ``mode='drop'`` all fact rows, which are also the
    source of the clean ones), and quarantine and counters are taken from them; the
    row counts come from the input. Counters observed in the writes would sit before the
    shuffle that sizes the files, where a repeated task counts twice. The scan of the
    findings packs them into right-sized tasks, so the quarantine is not shuffled again.

    ``mode='fail'`` (parity) raises on critical issues; ``mode='drop'`` (trap
    T18) writes the same evidence and returns the clean fact rows instead."""
    if mode not in ("fail", "drop"):
        raise ValueError("mode must be 'fail' or 'drop'")
    from lakeq.sources.sinks import write_quarantine

    for df, label in ((fact, rules.fact_label), (ref, rules.ref_label)):
        if not df.take(1):  # G2: one-row probe, before any write
            raise GateError(f"table {label} has no rows, nothing to validate")
    tf, tr = tag_fact(fact, ref, rules), tag_reference(ref, rules)
    spark = fact.sparkSession
    written, found = [], []
    for tagged, label, whole in ((tf, rules.fact_label, mode == "drop"), (tr, rules.ref_label, False)):
        path = scratch_path(spark, f"findings-{label}")
        (tagged if whole else tagged.where(F.size(REASONS) > 0)).write.parquet(path)
        written.append(spark.read.schema(tagged.schema).parquet(path))
        found.append(written[-1].where(F.size(REASONS) > 0))
        write_quarantine(quarantine_rows(found[-1], run_id, run_ts), quarantine_base, label, run_id, rebalance=False)
    values = {r.metric_name: r.metric_value for r in counters(*found, rules).collect()}
    values |= {f"{rules.fact_label}_row_count": fact.count(), f"{rules.ref_label}_row_count": ref.count()}
    rows = [(m, int(values[m]), s) for m, s in summary_layout(rules)]
    summary_df = spark.createDataFrame(rows, "metric_name string, metric_value bigint, severity string")
    summary_df.coalesce(1).write.mode("overwrite").parquet(summary_path)
    critical = sum(v for _, v, s in rows if s == "critical")
    outcome = ValidationOutcome(summary_df, values, critical, critical == 0,
                                clean_rows(written[0]) if mode == "drop" else None)
    if critical > 0 and raise_on_failure and mode == "fail":
        raise GateError(f"run {run_id}: {critical} critical findings in {rules.fact_label} and {rules.ref_label}; "
                        f"rows in {quarantine_base}, counts in {summary_path}")
    return outcome

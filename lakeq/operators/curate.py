"""C3 build_dimension and C4 build_fact.

The dimension is one join: the fact's per-key survivor (one aggregate) left
joined to the reference's per-key survivor (one aggregate). Both sides arrive
hash-partitioned on the key, so the join adds no exchange. Matched keys become
official rows; unmatched fact keys become inferred rows with provenance flags.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeq.functions.casts import parse_date

# Provenance flags of official and inferred rows.
MATCH_FLAGS = {
    "official": ("matched", "provider_file", "N"),
    "inferred": ("inferred_from_staffing", "staffing_file", "Y"),
}
FLAG_COLUMNS = ("provider_match_status", "provider_reference_source", "provider_reference_gap_flag")


def survivor(df: DataFrame, key: str, columns: list[str] | None = None, prefix: str = "",
             order_by: list | None = None) -> DataFrame:
    """A3 with a deterministic survivor (trap T13): per key, the row that is
    smallest over ``order_by`` (columns or expressions; use ``F.desc`` -like
    negation for latest-first) and then over the remaining columns in order.

    Equal rows are first collapsed to one with a count, by a hash aggregate over
    the scan; only the collapsed rows are sorted for the minimum. The count is
    summed and tested, or the optimizer would drop that first step as redundant."""
    cols = [c for c in (columns if columns is not None else df.columns) if c != key]
    if not cols:
        return df.select(key).distinct()
    ranks = [(F.col(o) if isinstance(o, str) else o).alias(f"__lq_o{i}") for i, o in enumerate(order_by or [])]
    rank_names = [f"__lq_o{i}" for i in range(len(ranks))]
    collapsed = (df.select(key, *cols, *ranks).groupBy(key, *cols, *rank_names)
                 .agg(F.count(F.lit(1)).alias("__lq_rows")))
    picked = (collapsed.groupBy(key).agg(F.min(F.struct(*rank_names, *cols)).alias("__lq_s"),
                                         F.sum("__lq_rows").alias("__lq_rows"))
              .where(F.col("__lq_rows") > 0))
    return picked.select(key, *[F.col(f"__lq_s.{c}").alias(prefix + c) for c in cols])


def build_dimension(ref: DataFrame, fact: DataFrame, *, ref_key: str, dim_key: str, fact_key: str,
                    inferred_attrs: dict[str, str], carried: dict[str, str], run_id: str, run_ts,
                    keep_unreferenced: bool = False, flag_columns=FLAG_COLUMNS,
                    flag_values=MATCH_FLAGS, ref_order: list | None = None,
                    fact_order: list | None = None) -> DataFrame:
    """Official rows (reference keys seen in the fact, plus ``carried`` fact
    attributes) union inferred rows (fact keys missing from the reference).

    ``inferred_attrs`` maps fact column -> dimension column filled on inferred
    rows; ``carried`` maps fact column -> dimension column on every row (J4).
    ``keep_unreferenced=False`` keeps parity: reference keys without fact rows
    are dropped (J4 is an inner join there). ``ref_order`` / ``fact_order``
    choose which row survives per key (default: smallest row)."""
    ref_base = ref.withColumnRenamed(ref_key, dim_key) if ref_key != dim_key else ref
    stamped = {"run_id", "curated_ts_utc", *flag_columns}  # replaced by this run's values
    ref_base = ref_base.drop(*[c for c in stamped if c in ref_base.columns])
    ref_cols = [c for c in ref_base.columns if c != dim_key]
    ref_surv = survivor(ref_base, dim_key, order_by=ref_order).withColumn("__lq_hit", F.lit(True))

    fact_cols = list(dict.fromkeys([*inferred_attrs, *carried]))
    fact_sel = fact.select(F.col(fact_key).alias(dim_key), *fact_cols,
                           *[(F.col(o) if isinstance(o, str) else o).alias(f"__lq_fo{i}")
                             for i, o in enumerate(fact_order or [])])
    fact_surv = survivor(fact_sel, dim_key, columns=[dim_key, *fact_cols], prefix="__lq_f_",
                         order_by=[f"__lq_fo{i}" for i in range(len(fact_order or []))]
                         ).withColumn("__lq_seen", F.lit(True))

    joined = fact_surv.join(ref_surv, dim_key, "full" if keep_unreferenced else "left")
    hit = F.col("__lq_hit").isNotNull()
    # A carried column that the reference also has keeps the reference's value on
    # official rows; inferred rows have only the fact to take it from.
    by_dim = {v: k for k, v in {**carried, **inferred_attrs}.items()}
    out = [F.col(dim_key)]
    for c in ref_cols:
        if c in by_dim:
            out.append(F.when(hit, F.col(c)).otherwise(F.col("__lq_f_" + by_dim[c])).alias(c))
        else:
            out.append(F.col(c))
    for src, dst in carried.items():
        if dst not in ref_cols:
            out.append(F.col("__lq_f_" + src).alias(dst))
    off, inf = flag_values["official"], flag_values["inferred"]
    for i, name in enumerate(flag_columns):
        out.append(F.when(hit, F.lit(off[i])).otherwise(F.lit(inf[i])).alias(name))
    out.append(F.lit(run_id).alias("run_id"))
    out.append(F.lit(run_ts).cast("timestamp").alias("curated_ts_utc"))
    return joined.select(out)


def build_fact(fact: DataFrame, *, date_col: str = "workdate", fmt: str = "yyyyMMdd", drop=(),
               run_id: str, run_ts) -> DataFrame:
    """C4: parse the day (bad text -> NULL, counted by ``bad_date_count``), add
    date parts and run stamps, drop the descriptive columns kept in the dimension."""
    work_date = parse_date(F.col(date_col), fmt)
    out = (fact.withColumn("work_date", work_date)
           .withColumns({
               "work_year": F.year("work_date"),
               "work_month": F.month("work_date"),
               "work_day": F.dayofmonth("work_date"),
               "run_id": F.lit(run_id),
               "curated_ts_utc": F.lit(run_ts).cast("timestamp"),
           }))
    return out.drop(*[c for c in drop if c in out.columns])


def bad_date_count(curated_fact: DataFrame) -> DataFrame:
    """G4 evidence: rows whose day did not parse (a NULL input counts too)."""
    return curated_fact.agg(F.count_if(F.col("work_date").isNull()).alias("bad_workdate_count"))

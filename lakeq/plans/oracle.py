"""Independent SQL for every driver query, runnable by DuckDB on the driver views.

The SQL restates each rule directly (NOT EXISTS for anti joins, quantile_cont
for quartiles, GROUP BY ... HAVING for duplicates) instead of mirroring the
DataFrame plans. Decimal sums are cast to DOUBLE at the end on both sides.
"""

from __future__ import annotations

from itertools import combinations

from lakeq.functions.text import NA_TOKENS

NUMERIC_RX = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
ISSUE = "Possible numeric values stored as text"

# Column types of the profiled driver tables, as Spark names them.
SCHEMAS = {
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                 ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                 ("c_acctbal", "double"), ("c_mktsegment", "string")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "int"), ("p_retailprice", "double")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"),
                 ("s_acctbal", "double")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
               ("event_type", "string"), ("value", "double"), ("props", "string")],
}


def _money(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(12,2)) AS VARCHAR)"


def _lenient_int(x: str, sql_type: str) -> str:
    sign = f"regexp_extract({x}, '^([+-]?)', 1)"
    digits = f"regexp_extract({x}, '^[+-]?([0-9]*)', 1)"
    return (f"CASE WHEN regexp_matches({x}, '^[+-]?[0-9]*[.]?[0-9]*$') AND regexp_matches({x}, '[0-9.]') "
            f"THEN TRY_CAST({sign} || CASE WHEN {digits} = '' THEN '0' ELSE {digits} END AS {sql_type}) END")


def _clean_name(x: str) -> str:
    base = (f"CASE WHEN {x} IS NULL OR {x} = '' THEN 'unknown.csv' ELSE "
            f"regexp_replace(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), '[ /\\\\]', '_', 'g') END")
    return f"CASE WHEN ends_with({base}, '.csv') THEN {base} ELSE {base} || '.csv' END"


def _dec_sum(cols) -> str:
    return " + ".join(f"coalesce({c}, 0)" for c in cols)


def _scaled(c: str, factor: str) -> str:
    return f"CAST({c} AS DECIMAL(12,2)) * CAST({factor} AS DECIMAL(5,4)) AS {c}"


MEASURES = f"""m AS (
  SELECT l_orderkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate, CAST(l_quantity AS DECIMAL(12,2)) AS l_quantity,
    {_scaled('l_extendedprice', '0.0137')}, {_scaled('l_discount', '0.0013')}, {_scaled('l_tax', '0.0007')}
  FROM lineitem)"""
EVENTS_GAPS = """(SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 13 <> 0 THEN value END AS value,
  CASE WHEN event_id % 3 <> 0 THEN props END AS props, 'web' AS channel, CAST(user_id AS VARCHAR) AS user_text
  FROM events)"""


RAW = f"""raw AS (
  SELECT
    trim(CAST(l_orderkey AS VARCHAR)) AS c_orderkey,
    trim(CAST(l_partkey AS VARCHAR)) AS c_partkey,
    trim(CAST(l_suppkey AS VARCHAR)) AS c_suppkey,
    trim(CASE WHEN l_orderkey % 7 = 0 THEN CAST(l_linenumber AS VARCHAR) || '.7'
         ELSE CAST(l_linenumber AS VARCHAR) END) AS c_line,
    NULLIF(trim(CASE WHEN l_partkey % 97 = 0 THEN '' WHEN l_partkey % 89 = 0 THEN '   '
         ELSE {_money('l_quantity')} END), '') AS c_qty,
    trim(CASE WHEN l_partkey % 83 = 0 THEN 'n/a' ELSE {_money('l_extendedprice')} END) AS c_price,
    trim(CASE WHEN l_partkey % 79 = 0 THEN '1,' || {_money('l_discount')} ELSE {_money('l_discount')} END)
      AS c_disc,
    trim(CASE WHEN l_partkey % 73 = 0 THEN '123.4567' ELSE {_money('l_tax')} END) AS c_tax,
    NULLIF(trim(CASE WHEN l_orderkey % 11 = 0 THEN ' ' ELSE l_returnflag END), '') AS c_flag,
    strftime(l_shipdate, '%Y%m%d') AS c_ship
  FROM lineitem)"""

TYPED = f"""typed AS (
  SELECT *,
    c_orderkey AS t_orderkey,
    {_lenient_int('c_partkey', 'BIGINT')} AS t_partkey,
    {_lenient_int('c_suppkey', 'INTEGER')} AS t_suppkey,
    {_lenient_int('c_line', 'INTEGER')} AS t_line,
    TRY_CAST(c_qty AS DECIMAL(10,2)) AS t_qty,
    TRY_CAST(c_price AS DECIMAL(10,2)) AS t_price,
    TRY_CAST(c_disc AS DECIMAL(10,2)) AS t_disc,
    TRY_CAST(c_tax AS DECIMAL(4,2)) AS t_tax
  FROM raw)"""

STAGED = """stg AS (
  SELECT
    CASE WHEN l_partkey % 101 = 0 THEN NULL WHEN l_partkey % 113 = 0 THEN l_orderkey + 1000000000000
         ELSE l_orderkey END AS l_orderkey,
    l_partkey, l_suppkey,
    CASE WHEN l_partkey % 103 = 0 THEN NULL ELSE l_linenumber END AS l_linenumber,
    l_quantity, l_extendedprice,
    CASE WHEN l_partkey % 107 = 0 THEN -l_discount ELSE l_discount END AS l_discount,
    CASE WHEN l_partkey % 109 = 0 THEN -l_tax ELSE l_tax END AS l_tax,
    l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS ship_date
  FROM lineitem)"""

STG_COLS = ("s.l_orderkey, s.l_partkey, s.l_suppkey, s.l_linenumber, s.l_quantity, s.l_extendedprice, "
            "s.l_discount, s.l_tax, s.l_returnflag, s.l_linestatus, s.ship_date")

TAGGED = f"""{STAGED},
one AS (SELECT CASE WHEN o_custkey % 211 <> 0 THEN o_orderkey END AS o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders),
ref AS (SELECT * FROM one UNION ALL SELECT * FROM one WHERE o_custkey % 97 = 0),
dupk AS (
  SELECT l_orderkey, l_linenumber, count(*) AS n FROM stg
  WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1),
tagged AS (
  SELECT {STG_COLS},
    (s.l_orderkey IS NULL OR s.l_linenumber IS NULL) AS is_missing,
    d.n IS NOT NULL AS is_dup,
    coalesce(s.l_quantity < 0 OR s.l_extendedprice < 0 OR s.l_discount < 0 OR s.l_tax < 0, false) AS is_neg,
    NOT EXISTS (SELECT 1 FROM ref r WHERE r.o_orderkey = s.l_orderkey) AS is_unmatched
  FROM stg s LEFT JOIN dupk d ON s.l_orderkey = d.l_orderkey AND s.l_linenumber = d.l_linenumber),
ref_dupk AS (SELECT o_orderkey FROM ref WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey HAVING count(*) > 1),
ref_tagged AS (
  SELECT r.*, r.o_orderkey IS NULL AS is_missing,
         r.o_orderkey IN (SELECT o_orderkey FROM ref_dupk) AS is_dup
  FROM ref r),
metrics AS (
  SELECT 'lineitem_row_count' AS metric_name, count(*) AS metric_value, 'info' AS severity FROM tagged
  UNION ALL SELECT 'orders_row_count', count(*), 'info' FROM ref_tagged
  UNION ALL SELECT 'bad_lineitem_required_count', count(*) FILTER (WHERE is_missing), 'critical' FROM tagged
  UNION ALL SELECT 'bad_orders_required_count', count(*) FILTER (WHERE is_missing), 'critical' FROM ref_tagged
  UNION ALL SELECT 'lineitem_duplicate_count', count(*) FILTER (WHERE is_dup), 'critical' FROM tagged
  UNION ALL SELECT 'orders_duplicate_count', count(*) FILTER (WHERE coalesce(is_dup, false)), 'critical'
    FROM ref_tagged
  UNION ALL SELECT 'negative_amounts_count', count(*) FILTER (WHERE is_neg), 'critical' FROM tagged
  UNION ALL SELECT 'unmatched_lineitem_count', count(*) FILTER (WHERE is_unmatched), 'warning' FROM tagged)"""

DOC_DIM = """f AS (
  SELECT doc_id, lang, source FROM (
    SELECT doc_id, lang, source,
           row_number() OVER (PARTITION BY doc_id ORDER BY lang NULLS FIRST, source NULLS FIRST) AS rn
    FROM (SELECT doc_id - doc_id % 2 AS doc_id, lang, source FROM documents)) WHERE rn = 1),
r AS (
  SELECT doc_id, quality, toxic FROM (
    SELECT doc_id, quality, toxic,
           row_number() OVER (PARTITION BY doc_id ORDER BY quality NULLS FIRST, toxic NULLS FIRST) AS rn
    FROM (SELECT doc_id - doc_id % 2 AS doc_id, quality, toxic FROM labels)) WHERE rn = 1),
dim AS (
  SELECT f.doc_id, r.quality, r.toxic, f.lang, f.source,
    CASE WHEN r.doc_id IS NOT NULL THEN 'matched' ELSE 'inferred_from_fact' END AS match_status,
    CASE WHEN r.doc_id IS NOT NULL THEN 'reference_file' ELSE 'fact_file' END AS reference_source,
    CASE WHEN r.doc_id IS NOT NULL THEN 'N' ELSE 'Y' END AS reference_gap_flag,
    'r1' AS run_id
  FROM f LEFT JOIN r ON f.doc_id = r.doc_id)"""

PART_TEXT = f"""p AS (
  SELECT p_partkey, p_name, p_brand,
    CASE WHEN p_partkey % 7 = 0 THEN 'n/a' WHEN p_partkey % 13 = 0 THEN '1d'
         WHEN p_partkey % 11 = 0 THEN ' ' || CAST(p_size AS VARCHAR) || ' '
         ELSE CAST(p_size AS VARCHAR) END AS p_size_text,
    CASE WHEN p_partkey % 3 = 0 THEN '$' || {_money('p_retailprice')} ELSE {_money('p_retailprice')} END
      AS p_retailprice_text
  FROM part)"""

HOURS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


RAW_TEXT = f"""rawtext AS (
  SELECT
    CAST(l_orderkey AS VARCHAR) AS k1, CAST(l_partkey AS VARCHAR) AS k2, CAST(l_suppkey AS VARCHAR) AS k3,
    CASE WHEN l_orderkey % 7 = 0 THEN CAST(l_linenumber AS VARCHAR) || '.7' ELSE CAST(l_linenumber AS VARCHAR) END
      AS k4,
    CASE WHEN l_partkey % 97 = 0 THEN '' WHEN l_partkey % 89 = 0 THEN '   ' ELSE {_money('l_quantity')} END AS k5,
    CASE WHEN l_partkey % 83 = 0 THEN 'n/a' ELSE {_money('l_extendedprice')} END AS k6,
    CASE WHEN l_partkey % 79 = 0 THEN '1,' || {_money('l_discount')} ELSE {_money('l_discount')} END AS k7,
    CASE WHEN l_partkey % 73 = 0 THEN '123.4567' ELSE {_money('l_tax')} END AS k8,
    CASE WHEN l_orderkey % 11 = 0 THEN ' ' ELSE l_returnflag END AS k9,
    strftime(l_shipdate, '%Y%m%d') AS k10
  FROM lineitem)"""
RAW_TEXT_NAMES = {"k1": " L OrderKey ", "k2": "L-PartKey", "k3": "L_SuppKey ", "k4": "Line Number (#)",
                  "k5": "Quantity", "k6": "Extended Price", "k7": "Discount", "k8": "Tax", "k9": "Return Flag",
                  "k10": "Ship Date"}
_TOKENS = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)


def _profile_read_cte() -> str:
    cols = ",\n    ".join(f"CASE WHEN {k} IN ({_TOKENS}) OR regexp_matches({k}, '^\\s*$') THEN NULL ELSE {k} END AS {k}"
                          for k in RAW_TEXT_NAMES)
    return f"pr AS (\n  SELECT\n    {cols}\n  FROM rawtext)"


def _inferred_types() -> str:
    parts = []
    for k, name in RAW_TEXT_NAMES.items():
        ints = (f"count(*) FILTER (WHERE regexp_matches(trim({k}), '^[+-]?[0-9]+$') "
                f"AND TRY_CAST(trim({k}) AS BIGINT) IS NOT NULL)")
        nums = f"count(*) FILTER (WHERE regexp_matches(trim({k}), '{NUMERIC_RX}'))"
        bools = f"count(*) FILTER (WHERE trim({k}) IN ('True', 'False', 'TRUE', 'FALSE', 'true', 'false'))"
        parts.append(f"""SELECT '{name}' AS column_name, count({k}) AS non_null_count, {ints} AS integer_count,
  {nums} AS numeric_count,
  CASE WHEN count({k}) = 0 THEN 'double'
       WHEN {ints} = count({k}) AND count({k}) = count(*) THEN 'bigint'
       WHEN {nums} = count({k}) THEN 'double'
       WHEN {bools} = count({k}) AND count({k}) = count(*) THEN 'boolean'
       ELSE 'string' END AS inferred_type
FROM pr""")
    return f"WITH {RAW_TEXT}, {_profile_read_cte()}\n" + "\nUNION ALL\n".join(parts)


def _merged_profile() -> str:
    parts = [f"""SELECT '{name}' AS column_name, 3::BIGINT AS runs, count(*) AS total_rows, count(*) - count({k}) AS missing_count,
  round(100.0 * (count(*) - count({k})) / count(*), 2)::DOUBLE AS missing_percent,
  CASE WHEN count({k}) > 0 AND count(DISTINCT {k}) <= 1000 THEN count(DISTINCT {k}) END AS distinct_values,
  CASE WHEN count({k}) > 0 AND count(DISTINCT {k}) <= 1000 THEN
    (SELECT max(n) FROM (SELECT count(*) AS n FROM pr WHERE {k} IS NOT NULL GROUP BY {k})) END AS most_frequent_count
FROM pr""" for k, name in RAW_TEXT_NAMES.items()]
    return (f"SELECT * FROM (WITH {RAW_TEXT}, {_profile_read_cte()}\n" + "\nUNION ALL\n".join(parts)
            + f") JOIN (SELECT column_name, inferred_type FROM ({_inferred_types()})) USING (column_name)")


def _missing_ranking() -> str:
    parts = [f"SELECT 'lineitem_raw' AS table_name, '{name}' AS column_name, count(*) - count({k}) AS missing_count "
             f"FROM pr" for k, name in RAW_TEXT_NAMES.items()]
    return f"WITH {RAW_TEXT}, {_profile_read_cte()}\n" + "\nUNION ALL\n".join(parts)


def _refine_typed() -> str:
    return f"""WITH {RAW}, {TYPED}
SELECT t_orderkey AS l_orderkey, t_partkey AS l_partkey, t_suppkey AS l_suppkey, t_line AS line_number,
       t_qty AS quantity, t_price AS extended_price, t_disc AS discount, t_tax AS tax,
       c_flag AS return_flag, c_ship AS ship_date,
       'r1' AS run_id, 'lineitem' AS dataset_name, 'lineitem.csv' AS source_file_name
FROM typed"""


def _cast_loss() -> str:
    pairs = [("l_orderkey", "c_orderkey", "t_orderkey"), ("l_partkey", "c_partkey", "t_partkey"),
             ("l_suppkey", "c_suppkey", "t_suppkey"), ("line_number", "c_line", "t_line"),
             ("quantity", "c_qty", "t_qty"), ("extended_price", "c_price", "t_price"),
             ("discount", "c_disc", "t_disc"), ("tax", "c_tax", "t_tax"),
             ("return_flag", "c_flag", "c_flag"), ("ship_date", "c_ship", "c_ship")]
    parts = [f"SELECT '{n}' AS column_name, count(*) FILTER (WHERE {c} IS NOT NULL AND {t} IS NULL) AS cast_loss "
             f"FROM typed" for n, c, t in pairs]
    return f"WITH {RAW}, {TYPED}\n" + "\nUNION ALL ".join(parts)


def _contract_columns() -> str:
    cols = [("l_orderkey", "string", "c_orderkey", "t_orderkey"), ("l_partkey", "bigint", "c_partkey", "t_partkey"),
            ("l_suppkey", "int", "c_suppkey", "t_suppkey"), ("line_number", "int", "c_line", "t_line"),
            ("quantity", "decimal(10,2)", "c_qty", "t_qty"), ("extended_price", "decimal(10,2)", "c_price", "t_price"),
            ("discount", "decimal(10,2)", "c_disc", "t_disc"), ("tax", "decimal(4,2)", "c_tax", "t_tax"),
            ("return_flag", "string", "c_flag", "c_flag"), ("ship_date", "string", "c_ship", "c_ship")]
    parts = [f"SELECT count(*) AS row_count, '{n}' AS column_name, '{t}' AS type, true AS in_data, "
             f"count({c}) AS with_text, count({v}) AS with_value, CAST(NULL AS VARCHAR) AS warning FROM typed"
             for n, t, c, v in cols]
    parts.append("SELECT count(*), 'commit_date', 'string', false, NULL, NULL, "
                 "'lineitem_raw: no column ''commit_date'' in the data, so it is not cast' FROM typed")
    return f"WITH {RAW}, {TYPED}\n" + "\nUNION ALL ".join(parts)


def _null_tokens() -> str:
    tokens = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)
    return f"""WITH c AS (
  SELECT CASE WHEN c_custkey % 17 = 0 THEN 'N/A' WHEN c_custkey % 19 = 0 THEN chr(9) || ' '
              WHEN c_custkey % 23 = 0 THEN 'unknown' WHEN c_custkey % 29 = 0 THEN '  '
              WHEN c_custkey % 31 = 0 THEN '-' ELSE c_mktsegment END AS t
  FROM customer)
SELECT count(*) AS row_count,
       count(*) FILTER (WHERE t IS NULL OR regexp_matches(t, '^ *$')) AS null_after_blank,
       count(*) FILTER (WHERE t IS NULL OR t IN ({tokens})) AS null_after_na_tokens,
       count(*) FILTER (WHERE t IS NULL OR regexp_matches(t, '^\\s*$')) AS null_after_whitespace,
       count(*) FILTER (WHERE t IS NULL OR t IN ({tokens}) OR regexp_matches(t, '^\\s*$'))
         AS null_after_profile_read
FROM c"""


def _profile_columns() -> str:
    parts = []
    for t, cols in {**SCHEMAS, "events": [*SCHEMAS["events"], ("channel", "string"), ("user_text", "string")]}.items():
        for c, dtype in cols:
            if dtype == "string":
                issue = (f"CASE WHEN count({c}) > 0 AND CAST(count(*) FILTER (WHERE regexp_matches(trim({c}), "
                         f"'{NUMERIC_RX}')) AS DOUBLE) / count({c}) >= 0.8 THEN '{ISSUE}' ELSE '' END")
            else:
                issue = "''"
            parts.append(f"""SELECT '{t}' AS table_name, '{c}' AS column_name, '{dtype}' AS dtype,
  count(*) AS row_count, count({c}) AS non_null_count, count(*) - count({c}) AS missing_count,
  CASE WHEN count(*) = 0 THEN 0.0 ELSE round(CAST(count(*) - count({c}) AS DOUBLE) * 100.0 / count(*), 2) END
    AS missing_pct,
  CASE WHEN count(*) = 0 THEN 0.0 ELSE round(CAST(count({c}) AS DOUBLE) * 100.0 / count(*), 2) END
    AS completeness_pct,
  count(DISTINCT {c}) AS unique_non_null_values,
  count(DISTINCT {c}) <= 1 AS constant_column_flag,
  CASE WHEN count(*) = 0 THEN false ELSE CAST(count(*) - count({c}) AS DOUBLE) / count(*) >= 0.2 END
    AS high_missing_flag,
  {issue} AS possible_type_issue
FROM {EVENTS_GAPS if t == 'events' else t}""")
    return "\nUNION ALL\n".join(parts)


NUMBERS = [("events", "value"), ("events", "user_id")] + [("lineitem", c) for c in (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")]


def _source(t: str) -> str:
    return EVENTS_GAPS if t == "events" else t


def _numeric_summary() -> str:
    parts = [f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS count,
  round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min(CAST({c} AS DOUBLE)), 6) AS min,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75, round(max(CAST({c} AS DOUBLE)), 6) AS max
FROM {_source(t)}""" for t, c in NUMBERS]
    return "\nUNION ALL\n".join(parts)


def _iqr_outliers() -> str:
    parts = []
    for t, c in NUMBERS:
        x = f"CAST({c} AS DOUBLE)"
        out = f"({x} < b.q1 - 1.5 * (b.q3 - b.q1) OR {x} > b.q3 + 1.5 * (b.q3 - b.q1))"
        parts.append(f"""SELECT '{t}' AS table_name, '{c}' AS column_name,
  count(*) FILTER (WHERE {out}) AS outlier_count,
  CASE WHEN count(*) = 0 THEN 0.0 ELSE round(CAST(count(*) FILTER (WHERE {out}) AS DOUBLE) * 100.0 / count(*), 2)
  END AS outlier_pct
FROM {_source(t)} x, (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3 FROM {_source(t)}) b""")
    return "\nUNION ALL\n".join(parts)


def _fact_daily() -> str:
    return """WITH e AS (
  SELECT *, CASE WHEN event_id % 17 <> 0 THEN CAST(ts AS DATE) END AS work_date FROM events)
SELECT event_id, user_id, event_type, value, work_date,
       CAST(year(work_date) AS INTEGER) AS work_year, CAST(month(work_date) AS INTEGER) AS work_month,
       CAST(day(work_date) AS INTEGER) AS work_day, 'r1' AS run_id
FROM e"""


def _csv_profile() -> str:
    kinds = []
    for k, name in RAW_TEXT_NAMES.items():
        kinds.append(f"SELECT 'lineitem' AS table_name, '{name}' AS column_name, count(*) - count({k}) AS missing_count FROM pr")
    counts = "\nUNION ALL\n".join(kinds)
    return (f"WITH t AS ({_inferred_types()}), c AS (WITH {RAW_TEXT}, {_profile_read_cte()}\n{counts})\n"
            "SELECT c.table_name, c.column_name, c.missing_count, t.inferred_type FROM c JOIN t USING (column_name)")


def _numeric_like_text() -> str:
    spec = [("part", "p", c) for c in ("p_name", "p_brand", "p_size_text", "p_retailprice_text")] + \
           [("events", "events", c) for c in ("event_type", "props")]
    parts = []
    for t, src, c in spec:
        ok = f"count(*) FILTER (WHERE regexp_matches(trim({c}), '{NUMERIC_RX}'))"
        parts.append(f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS non_null_count,
  {ok} AS numeric_count,
  CASE WHEN count({c}) = 0 THEN NULL ELSE round(CAST({ok} AS DOUBLE) / count({c}), 6) END AS numeric_share,
  CASE WHEN count({c}) = 0 THEN false ELSE CAST({ok} AS DOUBLE) / count({c}) >= 0.8 END AS numeric_like
FROM {src}""")
    return f"WITH {PART_TEXT}\n" + "\nUNION ALL\n".join(parts)


def _key_report() -> str:
    keys = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
            "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"],
            "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"], "documents": ["doc_id"],
            "labels": ["doc_id"], "pages": ["page_id"], "conversations": ["conv_id", "turn"]}
    parts = []
    for t, k in keys.items():
        dup = "coalesce(sum(k) FILTER (WHERE k > 1), 0)"
        parts.append(f"""SELECT '{t}' AS table_name, '{",".join(k)}' AS key_columns,
  CAST(coalesce(sum(k), 0) AS BIGINT) AS row_count, count(*) AS distinct_keys,
  CAST({dup} AS BIGINT) AS duplicate_key_rows, {dup} = 0 AS key_unique
FROM (SELECT count(*) AS k FROM {t} GROUP BY {", ".join(k)})""")
    return "\nUNION ALL\n".join(parts)


def _manifest_pending() -> str:
    size = "CAST(strlen(html) AS BIGINT)"
    return f"""WITH m AS (
  SELECT page_id, url, html,
         regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1) AS host,
         regexp_extract(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*(/[^?#]*)?', 1), '([^/]*)$', 1) AS nm
  FROM pages),
all_m AS (
  SELECT 'r2' AS run_id, 'web' AS source, host AS dataset, CAST(page_id AS VARCHAR) AS file_id,
         {_clean_name('nm')} AS file_name, url AS path, {size} AS size_bytes
  FROM m),
done AS (SELECT host AS dataset, url AS path, {size} AS size_bytes FROM m WHERE starts_with(url, 'https://'))
SELECT * FROM all_m a
WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.dataset = a.dataset AND d.path = a.path
                  AND d.size_bytes = a.size_bytes)"""


_QUARANTINE = f"""WITH {TAGGED}
SELECT {STG_COLS.replace('s.', '')}, 'missing_required_lineitem_fields' AS quarantine_reason
FROM tagged WHERE is_missing
UNION ALL SELECT {STG_COLS.replace('s.', '')}, 'duplicate_lineitem_keys' FROM tagged WHERE is_dup
UNION ALL SELECT {STG_COLS.replace('s.', '')}, 'negative_lineitem_amounts' FROM tagged WHERE is_neg
UNION ALL SELECT {STG_COLS.replace('s.', '')}, 'unmatched_orders_reference_warning'
FROM tagged WHERE is_unmatched"""

def _correlation_matrix() -> str:
    names = ("quantity", "extended_price", "discount", "tax")
    totals = ", ".join(f"CAST(sum({c}) AS DOUBLE) AS {n}" for n, c in zip(
        names, ("l_quantity", "l_extendedprice", "l_discount", "l_tax")))
    pairs = list(combinations((*names, "s_acctbal"), 2))
    rows = " UNION ALL ".join(f"SELECT '{x}' AS x, '{y}' AS y, count(*) AS n_pairs, round(corr({x}, {y}), 9) AS correlation "
                              "FROM a" for x, y in pairs)
    return f"""WITH {MEASURES}, t AS (SELECT l_suppkey, {totals} FROM m GROUP BY l_suppkey),
a AS (SELECT t.*, s.s_acctbal FROM t JOIN supplier s ON s.s_suppkey = t.l_suppkey)
{rows}"""


SERVED = """served AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, CAST(o.o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
    CAST(o.o_orderdate AS DATE) AS o_orderdate, o.o_orderpriority, CAST(year(o.o_orderdate) AS INTEGER) AS order_year,
    CAST(month(o.o_orderdate) AS INTEGER) AS order_month, c.c_nationkey AS cust_nation, c.c_mktsegment AS cust_segment,
    c.c_acctbal AS cust_balance
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""

ORACLE: dict[str, str] = {
    "refine_typed": _refine_typed(),
    "cast_loss": _cast_loss(),
    "null_tokens": _null_tokens(),
    "missing_key_rows": f"WITH {STAGED}\nSELECT * FROM stg WHERE l_orderkey IS NULL OR l_linenumber IS NULL",
    "negative_rows": """SELECT 'customer' AS table_name, c_custkey AS row_key, c_acctbal AS value
FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier WHERE s_acctbal < 0""",
    "duplicate_key_rows": """WITH d AS (
  SELECT l_orderkey, l_linenumber, count(*) AS dup_count FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
SELECT li.l_orderkey, li.l_partkey, li.l_suppkey, li.l_linenumber, li.l_quantity, li.l_extendedprice,
       li.l_discount, li.l_tax, li.l_returnflag, li.l_linestatus, CAST(li.l_shipdate AS DATE) AS l_shipdate,
       d.dup_count
FROM lineitem li JOIN d ON li.l_orderkey = d.l_orderkey AND li.l_linenumber = d.l_linenumber""",
    "duplicate_key_rows_nullsafe": f"""WITH {STAGED},
d AS (SELECT l_orderkey, l_linenumber, count(*) AS dup_count FROM stg
      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
SELECT {STG_COLS}, d.dup_count
FROM stg s JOIN d ON s.l_orderkey IS NOT DISTINCT FROM d.l_orderkey
                 AND s.l_linenumber IS NOT DISTINCT FROM d.l_linenumber""",
    "unmatched_rows": """SELECT * FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "unreferenced_keys": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
    "validation_summary": f"WITH {TAGGED}\nSELECT metric_name, CAST(metric_value AS BIGINT) AS metric_value, "
                          f"severity FROM metrics",
    "validation_gate": f"""WITH {TAGGED}
SELECT CAST(sum(CASE WHEN severity = 'critical' THEN metric_value ELSE 0 END) AS BIGINT) AS critical_total,
       CAST((SELECT count(*) FROM tagged WHERE is_missing OR is_dup OR is_neg)
          + (SELECT count(*) FROM ref_tagged WHERE is_missing OR coalesce(is_dup, false)) AS BIGINT)
         AS distinct_bad_rows,
       CAST(sum(CASE WHEN severity = 'warning' THEN metric_value ELSE 0 END) AS BIGINT) AS warning_total,
       sum(CASE WHEN severity = 'critical' THEN metric_value ELSE 0 END) = 0 AS passed
FROM metrics""",
    "quarantine_rows": f"""WITH {TAGGED}
SELECT {STG_COLS.replace('s.', '')}, 'missing_required_lineitem_fields' AS quarantine_reason, 'r1' AS run_id
FROM tagged WHERE is_missing
UNION ALL SELECT {STG_COLS.replace('s.', '')}, 'duplicate_lineitem_keys', 'r1' FROM tagged WHERE is_dup
UNION ALL SELECT {STG_COLS.replace('s.', '')}, 'negative_lineitem_amounts', 'r1' FROM tagged WHERE is_neg
UNION ALL SELECT {STG_COLS.replace('s.', '')}, 'unmatched_orders_reference_warning', 'r1'
FROM tagged WHERE is_unmatched""",
    "dim_with_inferred": f"WITH {DOC_DIM}\nSELECT * FROM dim",
    "dim_drops_unreferenced": """WITH f AS (
  SELECT user_id AS customer_key, min(event_type) AS first_event_type FROM events GROUP BY user_id),
r AS (
  SELECT c_custkey AS customer_key, c_name, c_nationkey, c_acctbal, c_mktsegment FROM (
    SELECT *, row_number() OVER (PARTITION BY c_custkey
      ORDER BY c_name NULLS FIRST, c_nationkey NULLS FIRST, c_acctbal NULLS FIRST, c_mktsegment NULLS FIRST) AS rn
    FROM customer) WHERE rn = 1)
SELECT f.customer_key, r.c_name, r.c_nationkey, r.c_acctbal, r.c_mktsegment, f.first_event_type,
  CASE WHEN r.customer_key IS NOT NULL THEN 'matched' ELSE 'inferred_from_fact' END AS match_status,
  CASE WHEN r.customer_key IS NOT NULL THEN 'reference_file' ELSE 'fact_file' END AS reference_source,
  CASE WHEN r.customer_key IS NOT NULL THEN 'N' ELSE 'Y' END AS reference_gap_flag,
  'r1' AS run_id
FROM f LEFT JOIN r ON f.customer_key = r.customer_key""",
    "fact_daily": _fact_daily(),
    "published_fact": _fact_daily(),
    "bad_dates": f"SELECT count(*) AS bad_workdate_count FROM ({_fact_daily()}) WHERE work_date IS NULL",
    "csv_roundtrip": """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey,
       p_name || [' "a ""b"', chr(10) || 'next, line', '; é€Ω', ',', ''][p_partkey % 5 + 1] AS p_name
FROM part""",
    "csv_profile": _csv_profile(),
    "csv_mixed_encodings": """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey,
       p_name || ' ' || ['é€Ω', 'é€', 'é' || chr(129)][p_partkey % 3 + 1] AS p_name,
       ['utf-8', 'cp1252', 'latin1'][p_partkey % 3 + 1] AS encoding
FROM part""",
    "merged_profile": _merged_profile(),
    "date_gaps_by_customer": """WITH obs AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL),
n AS (SELECT o_custkey, d, lead(d) OVER (PARTITION BY o_custkey ORDER BY d) AS e FROM obs)
SELECT o_custkey, d + 1 AS gap_from, e - 1 AS gap_to, CAST(e - d - 1 AS INTEGER) AS gap_days FROM n WHERE e - d > 1""",
    "missing_dates_by_priority": """WITH obs AS (
  SELECT DISTINCT o_orderpriority, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL),
cal AS (SELECT o_orderpriority, CAST(unnest(generate_series(CAST(min(d) AS TIMESTAMP), CAST(max(d) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
          AS missing_date FROM obs GROUP BY o_orderpriority)
SELECT * FROM cal WHERE NOT EXISTS (SELECT 1 FROM obs WHERE obs.d = cal.missing_date
                                    AND obs.o_orderpriority IS NOT DISTINCT FROM cal.o_orderpriority)""",
    "column_catalog": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{k}' AS dtype, count({c}) AS non_null_count FROM {t}"
        for t, cols in SCHEMAS.items() for c, k in cols),
    "inferred_long_keys": """SELECT CAST('1234567890' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS BIGINT) AS key19,
       '999999999999' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS key21 FROM orders""",
    "typed_numbers": f"""WITH {PART_TEXT}
SELECT p_partkey,
       CASE WHEN regexp_matches(trim(p_size_text), '{NUMERIC_RX}') THEN CAST(trim(p_size_text) AS DOUBLE) END AS p_size,
       CASE WHEN regexp_matches(trim(p_retailprice_text), '{NUMERIC_RX}') THEN CAST(trim(p_retailprice_text) AS DOUBLE) END
         AS p_retailprice
FROM p""",
    "manifest_last_entries": f"""WITH m AS (
  SELECT page_id, url, html, regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1) AS host,
         regexp_extract(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*(/[^?#]*)?', 1), '([^/]*)$', 1) AS nm,
         row_number() OVER (PARTITION BY regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1) ORDER BY page_id DESC) AS rn
  FROM pages)
SELECT host AS dataset, CAST(page_id AS VARCHAR) AS file_id, {_clean_name('nm')} AS file_name, url AS path,
       CAST(strlen(html) AS BIGINT) AS size_bytes, page_id AS pos
FROM m WHERE rn = 1""",
    "validation_run": f"WITH {TAGGED}\nSELECT metric_name, CAST(metric_value AS BIGINT) AS metric_value, "
                      f"severity FROM metrics",
    "quarantine_reference_roundtrip": f"""WITH {TAGGED}
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       'missing_required_orders_key' AS quarantine_reason FROM ref_tagged WHERE is_missing
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       'duplicate_orders_keys' FROM ref_tagged WHERE coalesce(is_dup, false)""",
    "dashboard_join": """SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice,
       CAST(o.o_orderdate AS DATE) AS o_orderdate, o.o_orderpriority,
       c.c_nationkey AS cust_nation, c.c_mktsegment AS cust_segment, c.c_acctbal AS cust_balance
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",
    "partition_roundtrip": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS ship_date,
       CAST(year(l_shipdate) AS INTEGER) AS ship_year, CAST(month(l_shipdate) AS INTEGER) AS ship_month
FROM lineitem""",
    "refined_run_roundtrip": _refine_typed(),
    "quarantine_roundtrip": _QUARANTINE,
    "dimension_roundtrip": f"WITH {DOC_DIM}\nSELECT * FROM dim",
    "profile_columns": _profile_columns(),
    "dataset_overview": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, {len(cols)} AS column_count FROM {t}"
        for t, cols in SCHEMAS.items()),
    "duplicate_full_rows": """SELECT user_id, CAST(ts AS DATE) AS event_date, event_type, count(*) AS row_count,
       count(*) - 1 AS extra_copies
FROM events GROUP BY user_id, CAST(ts AS DATE), event_type HAVING count(*) > 1""",
    "duplicate_text": """WITH g AS (SELECT text, count(*) AS k FROM documents GROUP BY text)
SELECT 'documents.text' AS table_name, CAST(coalesce(sum(k), 0) AS BIGINT) AS row_count,
       CAST(coalesce(sum(k - 1), 0) AS BIGINT) AS duplicate_row_count,
       CASE WHEN coalesce(sum(k), 0) = 0 THEN 0.0
            ELSE round(CAST(sum(k - 1) AS DOUBLE) * 100.0 / sum(k), 2) END AS duplicate_row_pct
FROM g""",
    "numeric_summary": _numeric_summary(),
    "inferred_types": _inferred_types(),
    "missing_ranking": _missing_ranking(),
    "iqr_outliers": _iqr_outliers(),
    "numeric_like_text": _numeric_like_text(),
    "range_violations": "SELECT * FROM customer WHERE (c_acctbal < 0 OR c_acctbal > 9000) AND c_custkey % 29 <> 0",
    "missing_dates": """WITH obs AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL),
cal AS (
  SELECT CAST(generate_series AS DATE) AS missing_date
  FROM generate_series((SELECT CAST(min(d) AS TIMESTAMP) FROM obs), (SELECT CAST(max(d) AS TIMESTAMP) FROM obs),
                       INTERVAL 1 DAY))
SELECT missing_date FROM cal WHERE NOT EXISTS (SELECT 1 FROM obs WHERE obs.d = cal.missing_date)""",
    "date_range": """SELECT min(CAST(o_orderdate AS DATE)) AS min_date, max(CAST(o_orderdate AS DATE)) AS max_date
FROM orders""",
    "key_uniqueness_report": _key_report(),
    "fact_view_flags": f"""WITH {DOC_DIM}
SELECT d.doc_id, d.lang, CAST(d.n_chars AS DECIMAL(10,2)) AS n_chars, m.match_status, m.reference_source,
       m.reference_gap_flag, 'r1' AS run_id
FROM documents d LEFT JOIN dim m ON d.doc_id = m.doc_id""",
    "hours_by_type": f"WITH {MEASURES}\n" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS measure_type, CAST(sum({c}) AS DOUBLE) AS total_hours FROM m"
        for t, c in (("quantity", "l_quantity"), ("extended_price", "l_extendedprice"),
                     ("discount", "l_discount"), ("tax", "l_tax"))),
    "emp_vs_ctr": f"""WITH {MEASURES}
SELECT l_returnflag,
       CAST(sum({_dec_sum(['l_quantity', 'l_extendedprice'])}) AS DOUBLE) AS emp_hours,
       CAST(sum({_dec_sum(['l_discount', 'l_tax'])}) AS DOUBLE) AS ctr_hours
FROM m GROUP BY l_returnflag""",
    "rating_in_out": f"""WITH {DOC_DIM}
SELECT toxic AS flag, round(avg(TRY_CAST(quality AS INTEGER)), 6) AS avg_rating,
       count(DISTINCT doc_id) AS provider_count
FROM dim GROUP BY toxic""",
    "total_by_provider": f"""WITH {MEASURES}
SELECT l_suppkey, CAST(sum({_dec_sum(HOURS)}) AS DOUBLE) AS total_hours
FROM m GROUP BY l_suppkey""",
    "total_by_provider_state_month": f"""WITH {MEASURES}
SELECT l.l_suppkey, n.n_name AS state,
       CAST(year(l.l_shipdate) AS INTEGER) AS work_year, CAST(month(l.l_shipdate) AS INTEGER) AS work_month,
       CAST(sum({_dec_sum(['l.' + c for c in HOURS])}) AS DOUBLE) AS total_hours
FROM m l JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey
GROUP BY l.l_suppkey, n.n_name, year(l.l_shipdate), month(l.l_shipdate)""",
    "load_ratio_bottom_k": f"""WITH {MEASURES}, g AS (
  SELECT l_suppkey, CAST(sum(l_discount) AS DOUBLE) AS total_hours,
         CAST(count(DISTINCT l_orderkey) AS DOUBLE) AS load
  FROM m GROUP BY l_suppkey)
SELECT l_suppkey, total_hours, load, round(ratio, 12) AS ratio
FROM (SELECT *, total_hours / NULLIF(load, 0) AS ratio FROM g ORDER BY ratio ASC NULLS LAST, l_suppkey LIMIT 10)""",
    "occupancy_by_provider": f"""WITH {MEASURES}, g AS (
  SELECT l_suppkey, CAST(avg(l_quantity) AS DOUBLE) AS avg_census FROM m GROUP BY l_suppkey)
SELECT g.l_suppkey, round(avg_census, 6) AS avg_census, CAST(s_nationkey AS DOUBLE) AS beds,
       round(avg_census / NULLIF(CAST(s_nationkey AS DOUBLE), 0), 6) AS occupancy
FROM g LEFT JOIN supplier ON s_suppkey = g.l_suppkey""",
    "corr_measures": f"""WITH {MEASURES}, t AS (
  SELECT l_suppkey, CAST(sum(l_quantity) AS DOUBLE) AS total_hours FROM m GROUP BY l_suppkey)
SELECT round(corr(t.total_hours, s.s_acctbal), 9) AS correlation, count(*) AS n_pairs
FROM t JOIN supplier s ON s.s_suppkey = t.l_suppkey""",
    "corr_load_ratio": f"""WITH {MEASURES}, t AS (
  SELECT l_suppkey, CAST(sum(l_discount) AS DOUBLE) / NULLIF(CAST(count(DISTINCT l_orderkey) AS DOUBLE), 0) AS ratio
  FROM m GROUP BY l_suppkey)
SELECT round(corr(t.ratio, s.s_acctbal), 9) AS correlation, count(*) AS n_pairs
FROM t JOIN supplier s ON s.s_suppkey = t.l_suppkey""",
    "perm_vs_contract": f"""WITH {MEASURES}, g AS (
  SELECT l_linestatus, sum(l_extendedprice) AS e, sum(l_discount) AS c, sum(l_quantity) AS l
  FROM m GROUP BY l_linestatus)
SELECT l_linestatus, CAST(e AS DOUBLE) AS emp_hours, CAST(c AS DOUBLE) AS ctr_hours,
       round(CAST(e AS DOUBLE) / NULLIF(CAST(c AS DOUBLE), 0), 6) AS emp_ctr_ratio,
       round(CAST(e AS DOUBLE) / NULLIF(CAST(l AS DOUBLE), 0), 6) AS emp_per_load,
       round(CAST(c AS DOUBLE) / NULLIF(CAST(l AS DOUBLE), 0), 6) AS ctr_per_load
FROM g""",
    "reference_gap": """SELECT count(*) AS unmatched_rows, count(DISTINCT doc_id) AS unmatched_keys
FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "manifest_pending": _manifest_pending(),
    "clean_file_name": f"""WITH p AS (SELECT p_partkey, ' ' || p_brand || '/' || p_name || '\\x ' AS raw_name FROM part)
SELECT p_partkey, raw_name, {_clean_name('raw_name')} AS file_name FROM p""",
    "duplicates_across_runs": f"""WITH {STAGED},
k AS (SELECT l_orderkey, l_linenumber, l_suppkey % 3 AS run, count(*) AS run_copies FROM stg
      WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY ALL),
h AS (SELECT *, coalesce(sum(run_copies) OVER w, 0) AS prior_copies, min(run) OVER w AS first_run FROM k
      WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT {STG_COLS}, h.run_copies, CAST(h.prior_copies AS BIGINT) AS prior_copies, 'r' || h.first_run AS first_run,
       'r' || h.run AS run_id
FROM stg s JOIN h ON s.l_orderkey = h.l_orderkey AND s.l_linenumber = h.l_linenumber AND s.l_suppkey % 3 = h.run
WHERE h.run_copies > 1 OR h.prior_copies > 0""",
    "snapshot_dashboard": f"WITH {SERVED}\nSELECT * FROM served",
    "snapshot_total_by_customer_month": f"""WITH {SERVED}
SELECT o_custkey, cust_nation, order_year, order_month, CAST(sum(o_totalprice) AS DOUBLE) AS total_hours
FROM served GROUP BY o_custkey, cust_nation, order_year, order_month""",
    "correlation_matrix": _correlation_matrix(),
    "files_by_content": """WITH l AS (
  SELECT 'b' || p_partkey % 5 AS dataset, p_partkey || ',' || p_name AS a,
    CASE WHEN p_partkey % 5 % 2 = 1 THEN p_partkey || ',' || replace(p_name, 'e', 'o') ELSE p_partkey || ',' || p_name END AS b
  FROM part)
SELECT dataset, count(*) AS lines, CAST(sum(strlen(b) + 1) AS BIGINT) AS size_bytes,
       CASE WHEN bool_and(a = b) THEN 'r1' END AS known_run
FROM l GROUP BY dataset""",
    "file_bounds": """SELECT count(*) AS row_count, min(o_orderkey) AS min_o_orderkey, max(o_orderkey) AS max_o_orderkey,
       min(o_custkey) AS min_o_custkey, max(o_custkey) AS max_o_custkey,
       min(CAST(o_orderdate AS DATE)) AS min_o_orderdate, max(CAST(o_orderdate AS DATE)) AS max_o_orderdate
FROM orders""",
    "contract_columns": _contract_columns(),
    "run_stamps": """SELECT 'r1' AS run_id, 'lineitem' AS dataset_name, 'r1.csv' AS source_file_name,
       '2024-07-01 00:00:00' AS stamp, count(*) AS row_count FROM lineitem
UNION ALL SELECT 'r2', 'lineitem', 'r2.csv', '2024-07-02 06:30:00', count(*) FROM lineitem
WHERE l_returnflag = 'R' AND l_orderkey % 11 <> 0""",
    "gate_outcomes": f"""WITH {TAGGED},
c AS (SELECT CAST(sum(metric_value) AS BIGINT) AS n FROM metrics WHERE severity = 'critical')
SELECT 'landed' AS scenario, 'GateError' AS outcome, n AS critical_total FROM c
UNION ALL SELECT 'no_key_column', 'ContractError', NULL
UNION ALL SELECT 'no_rows', 'GateError', NULL
UNION ALL SELECT 'drop', 'passed', n FROM c
UNION ALL SELECT 'clean', 'passed', 0""",
    "stage_ledger": """WITH d AS (
  SELECT l_suppkey, count(*) AS lines, sum(l_quantity) AS q FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)),
p AS (SELECT s_suppkey FROM supplier WHERE s_suppkey % 7 <> 0),
n AS (SELECT count(*) AS days, count(DISTINCT l_suppkey) AS providers,
             count(*) FILTER (WHERE lines % 3 = 0 AND q > 0) AS negative,
             count(*) FILTER (WHERE l_suppkey NOT IN (SELECT s_suppkey FROM p)) AS unmatched,
             (SELECT count(*) FROM p) AS listed FROM d),
r AS (SELECT 'r1' AS run_id, negative AS bad, n.* FROM n UNION ALL SELECT 'r2', 0, n.* FROM n)
SELECT run_id, 'refine' AS stage, 'staffing_hours_rows' AS metric, days AS value, true AS finished FROM r
UNION ALL SELECT run_id, 'refine', 'provider_reference_rows', listed, true FROM r
UNION ALL SELECT run_id, 'validate', 'staffing_row_count', days, run_id = 'r2' FROM r
UNION ALL SELECT run_id, 'validate', 'provider_row_count', listed, run_id = 'r2' FROM r
UNION ALL SELECT run_id, 'validate', 'bad_staffing_required_count', 0, run_id = 'r2' FROM r
UNION ALL SELECT run_id, 'validate', 'bad_provider_required_count', 0, run_id = 'r2' FROM r
UNION ALL SELECT run_id, 'validate', 'staffing_duplicate_count', 0, run_id = 'r2' FROM r
UNION ALL SELECT run_id, 'validate', 'provider_duplicate_count', 0, run_id = 'r2' FROM r
UNION ALL SELECT run_id, 'validate', 'negative_hours_count', bad, run_id = 'r2' FROM r
UNION ALL SELECT run_id, 'validate', 'unmatched_staffing_count', unmatched, run_id = 'r2' FROM r
UNION ALL SELECT run_id, 'curate', 'fact_staffing_daily_rows', days, true FROM r WHERE run_id = 'r2'
UNION ALL SELECT run_id, 'curate', 'dim_provider_rows', providers, true FROM r WHERE run_id = 'r2'""",
}

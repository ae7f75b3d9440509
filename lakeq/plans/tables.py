"""Driver tables and the deterministic derivations several plans share.

Derivations add the defects the checks look for (blank text, NULL keys,
negative amounts, text numbers) as pure functions of each row, over the whole
table; the oracle SQL derives the same values independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeq.models.staffing import HOUR_COLUMNS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _m(c: str, k: int) -> Column:
    return (F.col(c) % k) == 0


def money_text(c: str) -> Column:
    """A double with two decimals, written as text the same way by every engine."""
    return F.col(c).cast("decimal(12,2)").cast("string")


def lineitem_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem as a landed all-text file with untidy headers, blanks and
    decimal-looking integers (input of refine / cast-loss)."""
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias(" L OrderKey "),
        F.col("l_partkey").cast("string").alias("L-PartKey"),
        F.col("l_suppkey").cast("string").alias("L_SuppKey "),
        F.when(_m("l_orderkey", 7), F.concat(F.col("l_linenumber").cast("string"), F.lit(".7")))
        .otherwise(F.col("l_linenumber").cast("string")).alias("Line Number (#)"),
        F.when(_m("l_partkey", 97), F.lit("")).when(_m("l_partkey", 89), F.lit("   "))
        .otherwise(money_text("l_quantity")).alias("Quantity"),
        F.when(_m("l_partkey", 83), F.lit("n/a")).otherwise(money_text("l_extendedprice"))
        .alias("Extended Price"),
        F.when(_m("l_partkey", 79), F.concat(F.lit("1,"), money_text("l_discount")))
        .otherwise(money_text("l_discount")).alias("Discount"),
        F.when(_m("l_partkey", 73), F.lit("123.4567")).otherwise(money_text("l_tax")).alias("Tax"),
        F.when(_m("l_orderkey", 11), F.lit(" ")).otherwise(F.col("l_returnflag")).alias("Return Flag"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("Ship Date"),
    )


def lineitem_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem with NULL keys, keys without an order and negative amounts (input of
    validation checks)."""
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        F.when(_m("l_partkey", 101), F.lit(None)).when(_m("l_partkey", 113), F.col("l_orderkey") + 10**12)
        .otherwise(F.col("l_orderkey")).alias("l_orderkey"),
        "l_partkey", "l_suppkey",
        F.when(_m("l_partkey", 103), F.lit(None)).otherwise(F.col("l_linenumber")).alias("l_linenumber"),
        "l_quantity", "l_extendedprice",
        F.when(_m("l_partkey", 107), -F.col("l_discount")).otherwise(F.col("l_discount")).alias("l_discount"),
        F.when(_m("l_partkey", 109), -F.col("l_tax")).otherwise(F.col("l_tax")).alias("l_tax"),
        "l_returnflag", "l_linestatus",
        F.to_date("l_shipdate").alias("ship_date"),
    )


def orders_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference for validation: all orders, some without a key, some twice."""
    o = load(spark, sf_dir, "orders").select(
        F.when(_m("o_custkey", 211), F.lit(None)).otherwise(F.col("o_orderkey")).alias("o_orderkey"),
        "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority")
    return o.unionByName(o.where(_m("o_custkey", 97)))


def lineitem_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem with exact measures of different scales; price, discount and tax
    have six decimals."""
    li = load(spark, sf_dir, "lineitem")

    def scaled(c: str, factor: str) -> Column:
        return F.col(c).cast("decimal(12,2)") * F.lit(factor).cast("decimal(5,4)")
    return li.withColumns({
        "l_quantity": F.col("l_quantity").cast("decimal(12,2)"),
        "l_extendedprice": scaled("l_extendedprice", "0.0137"),
        "l_discount": scaled("l_discount", "0.0013"), "l_tax": scaled("l_tax", "0.0007")})


def events_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with NaN values, missing text, a constant and numbers as text."""
    ev = load(spark, sf_dir, "events")
    return ev.withColumns({
        "value": F.when(_m("event_id", 13), F.lit(float("nan"))).otherwise(F.col("value")),
        "props": F.when(~_m("event_id", 3), F.col("props")),
        "channel": F.lit("web"), "user_text": F.col("user_id").cast("string")})


def customer_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of whom some have NaN as balance."""
    return load(spark, sf_dir, "customer").withColumn(
        "c_acctbal", F.when(_m("c_custkey", 29), F.lit(float("nan"))).otherwise(F.col("c_acctbal")))


def orders_long_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys as text of 19 digits, which bigint holds but double does not, and
    of 21 digits, which neither holds."""
    key = F.lpad(F.col("o_orderkey").cast("string"), 9, "0")
    return load(spark, sf_dir, "orders").select(
        F.concat(F.lit("1234567890"), key).alias("key19"), F.concat(F.lit("999999999999"), key).alias("key21"))


def part_odd_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names with quotes, line breaks, separators and non-ASCII characters."""
    odd = F.array(*[F.lit(x) for x in (' "a ""b"', "\nnext, line", "; \u00e9\u20ac\u03a9", ",", "")])
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("p_partkey"),
        F.concat(F.col("p_name"), F.element_at(odd, (F.col("p_partkey") % 5 + 1).cast("int"))).alias("p_name"))


def part_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part attributes as text, some of it junk or number look-alikes."""
    p = load(spark, sf_dir, "part")
    return p.select(
        "p_partkey", "p_name", "p_brand",
        F.when(_m("p_partkey", 7), F.lit("n/a")).when(_m("p_partkey", 13), F.lit("1d"))
        .when(_m("p_partkey", 11), F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" ")))
        .otherwise(F.col("p_size").cast("string")).alias("p_size_text"),
        F.when(_m("p_partkey", 3), F.concat(F.lit("$"), money_text("p_retailprice")))
        .otherwise(money_text("p_retailprice")).alias("p_retailprice_text"),
    )


def customer_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer segment text with missing-value tokens and odd white space."""
    c = load(spark, sf_dir, "customer")
    seg = (F.when(_m("c_custkey", 17), F.lit("N/A")).when(_m("c_custkey", 19), F.lit("\t "))
           .when(_m("c_custkey", 23), F.lit("unknown")).when(_m("c_custkey", 29), F.lit("  "))
           .when(_m("c_custkey", 31), F.lit("-")).otherwise(F.col("c_mktsegment")))
    return c.select("c_custkey", seg.alias("segment_text"))


def part_by_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names that end in characters which tell three encodings apart."""
    tail = F.array(*[F.lit(x) for x in ("\u00e9\u20ac\u03a9", "\u00e9\u20ac", "\u00e9\u0081")])
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("p_partkey"),
        F.concat("p_name", F.lit(" "), F.element_at(tail, (F.col("p_partkey") % 3 + 1).cast("int"))).alias("p_name"))


def staffing_raw(spark: SparkSession, sf_dir: str, negative: bool) -> DataFrame:
    """A staffing file of all-text columns, one row per supplier and ship day; with
    ``negative``, days whose number of lines is a multiple of three have negative hours."""
    days = load(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"), F.sum("l_linenumber").alias("numbers"))
    sign = F.when(F.lit(negative) & (F.col("lines") % 3 == 0), -1).otherwise(1)
    hours = {"hrs_rn": sign * F.col("quantity"), "hrs_cna": F.col("numbers")}
    number = F.lpad(F.col("l_suppkey").cast("string"), 9, "0")
    return days.select(
        number.alias("PROVNUM"), F.concat(F.lit("Supplier "), number).alias("PROVNAME"), F.lit("Town").alias("CITY"),
        F.lit("ST").alias("STATE"), F.lit("County").alias("COUNTY_NAME"), F.lit("001").alias("COUNTY_FIPS"),
        F.lit("2024Q2").alias("CY_Qtr"), F.date_format("day", "yyyyMMdd").alias("WorkDate"),
        F.col("lines").cast("string").alias("MDScensus"),
        *[hours.get(c, F.lit(0)).cast("decimal(12,2)").cast("string").alias(c) for c in HOUR_COLUMNS])


def provider_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider file of all-text columns: the suppliers but for every seventh."""
    return load(spark, sf_dir, "supplier").where("s_suppkey % 7 <> 0").select(
        F.lpad(F.col("s_suppkey").cast("string"), 9, "0").alias("CMS Certification Number (CCN)"),
        F.col("s_name").alias("Provider Name"), F.lit("Town").alias("City/Town"), F.lit("ST").alias("State"),
        (F.col("s_nationkey") + 50).cast("string").alias("Number of Certified Beds"),
        F.lit("N").alias("Provider Resides in Hospital"), F.lit("4").alias("Overall Rating"))

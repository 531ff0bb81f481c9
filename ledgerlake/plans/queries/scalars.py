"""Registered scalar-function queries: one key ``scalar_f<n>`` each."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.functions import scalars as FN
from ledgerlake.plans import frames as FR
from ledgerlake.plans.catalog import query
from ledgerlake.plans.oracle import round_sql

ANCHOR = FR.ANCHOR_DATE


@query("scalar_f1", """
SELECT c_custkey, lower(c_name) AS name_lower, upper(c_mktsegment) AS tier_upper,
       trim('  ' || c_mktsegment || ' ') AS tier_trimmed, starts_with(c_name, 'Customer#00000') AS std_prefix
FROM customer""", frames=False)
def scalar_f1(t):
    """lower / upper / trim / startswith."""
    c = t.customer
    return c.select("c_custkey", F.lower("c_name").alias("name_lower"), F.upper("c_mktsegment").alias("tier_upper"),
                    F.trim(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" "))).alias("tier_trimmed"),
                    FN.starts_with_literal("c_name", "Customer#00000").alias("std_prefix"))


@query("scalar_f2", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount, CAST(o_orderdate AS DATE) AS order_date,
       TRY_CAST(CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS DATE) AS parsed_date,
       TRY_CAST(o_orderpriority AS INTEGER) AS priority_as_int
FROM orders""", frames=False)
def scalar_f2(t):
    """cast, ::DECIMAL, DATE cast, ISO date parse, failing cast -> null."""
    o = t.orders
    return o.select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").cast("double").alias("amount"),
                    F.col("o_orderdate").cast("date").alias("order_date"),
                    FN.parse_date(F.col("o_orderdate").cast("date").cast("string")).alias("parsed_date"),
                    FN.safe_cast("o_orderpriority", "int").alias("priority_as_int"))


@query("scalar_f3", f"""
SELECT l_orderkey, l_linenumber,
       {round_sql('CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))')} AS discount_value
FROM lineitem""", frames=False)
def scalar_f3(t):
    """ROUND(x, 2), half-up on exact decimals."""
    li = t.lineitem
    v = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(4,2)")
    return li.select("l_orderkey", "l_linenumber", FN.round2(v).alias("discount_value"))


@query("scalar_f4", """
SELECT transaction_id, CASE WHEN amount >= 100000 THEN 'large' WHEN amount >= 10000 THEN 'medium'
                            WHEN amount > 0 THEN 'small' ELSE 'none' END AS amount_band
FROM bronze""")
def scalar_f4(t):
    """CASE WHEN."""
    a = F.col("amount")
    band = F.when(a >= 100000, "large").when(a >= 10000, "medium").when(a > 0, "small").otherwise("none")
    return FR.bronze_frame(t).select("transaction_id", band.alias("amount_band"))


@query("scalar_f5", """
SELECT transaction_id, COALESCE(merchant_name, '') AS merchant_name, COALESCE(city, 'UNKNOWN') AS city,
       NULLIF(status, 'PENDING') AS status_or_null
FROM enr""")
def scalar_f5(t):
    """COALESCE, NULLIF and the ``or ""`` default."""
    e = FR.enr_frame(t)
    return e.select("transaction_id", F.coalesce("merchant_name", F.lit("")).alias("merchant_name"),
                    F.coalesce("city", F.lit("UNKNOWN")).alias("city"),
                    F.nullif(F.col("status"), F.lit("PENDING")).alias("status_or_null"))


@query("scalar_f6", f"""
WITH x AS (SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS HUGEINT) AS pc,
                  NULLIF(CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS HUGEINT), 0) AS dh FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST((pc * 200 + dh) // (2 * dh) AS DOUBLE) / 100 AS price_per_discount
FROM x""", frames=False)
def scalar_f6(t):
    """safe ratio — null when the denominator is 0 (``try_divide``)."""
    li = t.lineitem
    r = FN.ratio(F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_discount").cast("decimal(4,2)"))
    return li.select("l_orderkey", "l_linenumber", FN.round2(r).alias("price_per_discount"))


@query("scalar_f7", f"""
SELECT transaction_id, CAST(DATE_TRUNC('month', transaction_date) AS DATE) AS month_start,
       CAST(DATE_TRUNC('year', transaction_date) AS DATE) AS year_start,
       CAST(transaction_date + INTERVAL 1 MONTH AS DATE) AS plus_month, CAST(transaction_date - INTERVAL 7 DAY AS DATE) AS minus_week,
       transaction_date BETWEEN DATE_TRUNC('year', DATE '{ANCHOR}') AND DATE '{ANCHOR}' AS year_to_date
FROM ord""")
def scalar_f7(t):
    """DATE_TRUNC month/year, ± interval, BETWEEN dates."""
    d = F.col("transaction_date")
    return FR.ord_frame(t).select(
        "transaction_id", F.trunc(d, "month").alias("month_start"), F.trunc(d, "year").alias("year_start"),
        F.add_months(d, 1).alias("plus_month"), F.date_sub(d, 7).alias("minus_week"),
        d.between(F.trunc(F.lit(ANCHOR), "year"), F.lit(ANCHOR)).alias("year_to_date"))


@query("scalar_f8", f"""
SELECT transaction_id, CAST(DATE_DIFF('day', transaction_date, DATE '{ANCHOR}') AS INTEGER) AS days_to_anchor FROM ord""")
def scalar_f8(t):
    """F8: day difference to the anchor."""
    return FR.ord_frame(t).select("transaction_id", F.date_diff(F.lit(ANCHOR), "transaction_date").alias("days_to_anchor"))


@query("scalar_f9", """
SELECT s_suppkey, s_name LIKE 'Supplier#0000000%' AS like_match, regexp_matches(s_name, '[0-9]{3}5$') AS re_match,
       NOT regexp_matches(s_name, '^Supplier#') AS re_not_match
FROM supplier""", frames=False)
def scalar_f9(t):
    """LIKE, regex match, regex not-match."""
    s = t.supplier
    return s.select("s_suppkey", F.col("s_name").like("Supplier#0000000%").alias("like_match"),
                    F.col("s_name").rlike("[0-9]{3}5$").alias("re_match"),
                    (~F.col("s_name").rlike("^Supplier#")).alias("re_not_match"))


@query("scalar_f10", """
SELECT c_custkey, CAST(regexp_extract(c_name, '#0*([0-9]+)$', 1) AS BIGINT) AS name_number FROM customer""", frames=False)
def scalar_f10(t):
    """regex extract of a capture group."""
    return t.customer.select("c_custkey", F.regexp_extract("c_name", r"#0*([0-9]+)$", 1).cast("bigint")
                             .alias("name_number"))


@query("scalar_f11", """
SELECT transaction_id, sha256(CAST(customer_id AS VARCHAR)) AS customer_hash FROM ord""")
def scalar_f11(t):
    """SHA-256 mask of an id."""
    return FR.ord_frame(t).select("transaction_id", FN.mask_id("customer_id").alias("customer_hash"))


@query("scalar_f12", """
SELECT page_id, string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1] AS last_part,
       concat_ws('|', CAST(page_id AS VARCHAR), url) AS joined
FROM pages""", frames=False)
def scalar_f12(t):
    """concat_ws, last part of a path (query and fragment removed first)."""
    p = t.pages
    path = F.regexp_replace("url", r"[?#].*$", "")
    return p.select("page_id", FN.last_path_part(path).alias("last_part"),
                    F.concat_ws("|", F.col("page_id").cast("string"), F.col("url")).alias("joined"))


@query("scalar_f13", """
SELECT transaction_id, CAST(ABS(amount) AS DOUBLE) AS abs_amount FROM bronze""")
def scalar_f13(t):
    """ABS."""
    return FR.bronze_frame(t).select("transaction_id", F.abs("amount").cast("double").alias("abs_amount"))


@query("scalar_f14", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_path,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k_parsed,
       CAST(to_json({'event_id': event_id, 'event_type': event_type}) AS VARCHAR) AS record
FROM events""", frames=False)
def scalar_f14(t):
    """JSON decode (path and schema) and encode of a record."""
    e = t.events
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k_path"),
                    F.from_json("props", "k int").getField("k").alias("k_parsed"),
                    F.to_json(F.struct("event_id", "event_type")).alias("record"))


SPARK_SIMPLE_TYPES = ["boolean", "int", "bigint", "float", "double", "date", "timestamp", "string"]


def _f15_sql():
    from ledgerlake.plans.queries.drift import _log_sql
    known = ", ".join(f"'{x}'" for x in SPARK_SIMPLE_TYPES)
    return f"""WITH {_log_sql()}
SELECT batch_id, column_name, type, '`' || column_name || '` ' || type AS field_ddl, type IN ({known}) AS known_type
FROM log"""


@query("scalar_f15", _f15_sql(), frames=False)
def scalar_f15(t):
    """type name -> schema field. Every (batch, column, type name) of the
    schema log inferred from the feed's values becomes a DDL field string
    (``StructType.fromDDL`` reads it back) with a check that the name is a
    known Spark type."""
    from ledgerlake.operators import drift as SD
    log = SD.infer_schema_log(SD.raw_feed(t.orders))
    return log.select("batch_id", "column_name", "type",
                      F.concat(F.lit("`"), F.col("column_name"), F.lit("` "), F.col("type")).alias("field_ddl"),
                      F.col("type").isin(*SPARK_SIMPLE_TYPES).alias("known_type"))


@query("scalar_f16", """
SELECT event_id, ts + INTERVAL '5 hours 30 minutes' AS ts_ist FROM events""", frames=False)
def scalar_f16(t):
    """F16: time-zone shift UTC -> IST."""
    return t.events.select("event_id", F.convert_timezone(F.lit("UTC"), F.lit("Asia/Kolkata"), F.col("ts"))
                           .alias("ts_ist"))


@query("scalar_f17", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'COMPLETED' WHEN 'F' THEN 'FAILED' WHEN 'P' THEN 'PENDING' END AS status
FROM orders""", frames=False)
def scalar_f17(t):
    """small literal map lookup (``create_map``), null on a miss."""
    m = {"O": "COMPLETED", "F": "FAILED", "P": "PENDING"}
    return t.orders.select("o_orderkey", FN.lookup(m, "o_orderstatus").alias("status"))

"""Registered projection / filter queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.functions.scalars import safe_cast, surrogate_key
from ledgerlake.operators import filters as P
from ledgerlake.plans import frames as FR
from ledgerlake.plans.catalog import query

ANCHOR = FR.ANCHOR_DATE
CUTOFF = dt.date(2001, 1, 1)            # P7
TEST_PREFIX = "TEST_"                   # P6 literal prefix
CATEGORY = "NATION_7"                   # P9 bound parameter
REVIEW_THRESHOLD = 50000                # P11
BAND = 50000                            # P13

BRONZE_COLS = "transaction_id, amount, status, merchant_id, customer_id, transaction_date, payment_method"
SPARK_BRONZE_COLS = [c.strip() for c in BRONZE_COLS.split(",")]


@query("project_columns", "SELECT * FROM ord")
def project_columns(t):
    """Select and rename the order columns into payment names."""
    return FR.ord_frame(t)


DIRTY_SQL = """(SELECT CONCAT(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS transaction_id,
       CASE WHEN l_partkey % 71 = 5 THEN 'N/A' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount_raw,
       CASE WHEN l_partkey % 73 = 6 THEN '2024-13-45' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS date_raw
 FROM lineitem)"""


@query("safe_cast", f"""
SELECT transaction_id, CAST(TRY_CAST(amount_raw AS DECIMAL(18,2)) AS DOUBLE) AS amount,
       TRY_CAST(date_raw AS DATE) AS transaction_date,
       TRY_CAST(amount_raw AS DECIMAL(18,2)) IS NULL AS amount_cast_failed,
       TRY_CAST(date_raw AS DATE) IS NULL AS date_cast_failed
FROM {DIRTY_SQL} d""")
def safe_cast_q(t):
    """String -> decimal/date with ``try_cast``; failures become null and flagged."""
    li = t.lineitem
    pk = F.col("l_partkey")
    raw = li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
         .alias("transaction_id"),
        F.when(pk % 71 == 5, F.lit("N/A")).otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
         .alias("amount_raw"),
        F.when(pk % 73 == 6, F.lit("2024-13-45")).otherwise(F.col("l_shipdate").cast("date").cast("string"))
         .alias("date_raw"))
    amt = safe_cast("amount_raw", "decimal(18,2)")
    d = safe_cast("date_raw", "date")
    return raw.select("transaction_id", amt.cast("double").alias("amount"), d.alias("transaction_date"),
                      amt.isNull().alias("amount_cast_failed"), d.isNull().alias("date_cast_failed"))


@query("silver_row_filter", f"SELECT {BRONZE_COLS} FROM bronze WHERE transaction_id IS NOT NULL AND amount >= 0")
def silver_row_filter(t):
    """Id present and amount not negative."""
    return FR.silver_rules(FR.bronze_frame(t)).select(*SPARK_BRONZE_COLS)


@query("status_filter", "SELECT * FROM ord WHERE status = 'FAILED'")
def status_filter(t):
    """Equality filter."""
    return FR.ord_frame(t, statuses=["FAILED"])


@query("status_in_filter", "SELECT * FROM ord WHERE status IN ('COMPLETED', 'FAILED')")
def status_in_filter(t):
    """P5: ``status IN (...)``."""
    return FR.ord_frame(t, statuses=["COMPLETED", "FAILED"])


@query("exclude_test_prefix", f"""
SELECT merchant_id, merchant_name FROM merch WHERE NOT starts_with(merchant_name, '{TEST_PREFIX}')""")
def exclude_test_prefix(t):
    """Drop test merchants by the literal prefix "TEST_" (no LIKE wildcard)."""
    return P.exclude_prefix(FR.merch_frame(t), "merchant_name", TEST_PREFIX).select("merchant_id", "merchant_name")


@query("cutoff_after", f"SELECT * FROM ord WHERE transaction_date > DATE '{CUTOFF}'")
def cutoff_after(t):
    """Strictly after the cutoff date (the boundary day is excluded)."""
    return P.after_cutoff(FR.ord_frame(t, after=CUTOFF), "transaction_date", CUTOFF)


@query("date_range_filter", f"""
SELECT *, CAST(DATE_TRUNC('month', transaction_date) AS DATE) AS month
FROM ord WHERE transaction_date BETWEEN DATE_TRUNC('year', DATE '{ANCHOR}') AND DATE '{ANCHOR}'""")
def date_range_filter(t):
    """Year-to-date rows (year start .. anchor), each tagged with its half-open month window."""
    year_start = dt.date(ANCHOR.year, 1, 1)
    return P.year_to_date(FR.ord_frame(t, after=year_start - dt.timedelta(days=1), until=ANCHOR),
                          "transaction_date", ANCHOR)


@query("param_category_lookup", f"SELECT merchant_id, merchant_name FROM merch WHERE category = '{CATEGORY}'")
def param_category_lookup(t):
    """Merchants of a category with the value bound as a SQL parameter, never concatenated."""
    FR.merch_frame(t).createOrReplaceTempView("merch")
    return t.spark.sql("SELECT merchant_id, merchant_name FROM merch WHERE category = :category",
                       args={"category": CATEGORY})


@query("quality_flag", "SELECT transaction_id, merchant_id, quality_flag FROM enr")
def quality_flag(t):
    """P10: CLEAN / UNMATCHED by merchant lookup hit."""
    return FR.enr_frame(t).select("transaction_id", "merchant_id", "quality_flag")


@query("compliance_flag", f"""
SELECT transaction_id, amount, amount > {REVIEW_THRESHOLD} AS requires_review FROM enr""")
def compliance_flag(t):
    """requires_review when amount exceeds the threshold."""
    return P.compliance_flag(FR.enr_frame(t), REVIEW_THRESHOLD).select("transaction_id", "amount", "requires_review")


@query("positive_amount_filter", f"SELECT {BRONZE_COLS} FROM bronze WHERE amount > 0")
def positive_amount_filter(t):
    """Rows with amount > 0."""
    return FR.bronze_frame(t).where(F.col("amount") > 0).select(*SPARK_BRONZE_COLS)


@query("amount_band_filter", f"SELECT {BRONZE_COLS} FROM bronze WHERE amount > {BAND}")
def amount_band_filter(t):
    """Rows above the amount bound."""
    return FR.bronze_frame(t).where(F.col("amount") > BAND).select(*SPARK_BRONZE_COLS)


LOG_SQL = """(SELECT 'orders' AS source, o_orderkey AS entry_id, CAST(0 AS BIGINT) AS turn,
   CASE WHEN o_orderkey % 11 = 0 THEN ''
        WHEN o_orderkey % 6 = 0 THEN '```sql' || chr(10) || 'SELECT COUNT(*) FROM FACT_TRANSACTIONS WHERE CUSTOMER_ID = ' || CAST(o_custkey AS VARCHAR) || chr(10) || '```'
        WHEN o_orderkey % 6 = 1 THEN 'Here you go: ```' || chr(10) || 'select * from DIM_MERCHANT where merchant_id = ' || CAST(o_custkey AS VARCHAR) || chr(10) || '``` done'
        WHEN o_orderkey % 6 = 2 THEN 'SELECT ' || CAST(o_orderkey AS VARCHAR) || '; DROP TABLE FACT_TRANSACTIONS'
        WHEN o_orderkey % 6 = 3 THEN '```sql' || chr(10) || 'DELETE FROM FACT_TRANSACTIONS WHERE TRANSACTION_ID = ' || CAST(o_orderkey AS VARCHAR) || chr(10) || '```'
        WHEN o_orderkey % 6 = 4 THEN 'SELECT * FROM ORDERS_' || o_orderpriority || ' WHERE ID = ' || CAST(o_orderkey AS VARCHAR)
        ELSE '  select amount from fact_transactions where status = ''DROPPED'' and id = ' || CAST(o_orderkey AS VARCHAR) || chr(10) END AS text
 FROM orders
 UNION ALL SELECT 'conversations', conv_id, turn, text FROM conversations)"""

TRIM = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _trim(x):
    return TRIM.format(x=x)


EXTRACT_SQL = f"""COALESCE(
   {_trim("NULLIF(regexp_extract(text, '(?s)```sql\\s*(.*?)\\s*```', 1), '')")},
   {_trim("NULLIF(regexp_extract(text, '(?is)```\\s*(SELECT.*?)\\s*```', 1), '')")},
   CASE WHEN starts_with(upper({_trim('text')}), 'SELECT') THEN {_trim('text')} END)"""


@query("sql_text_extract", f"SELECT source, entry_id, turn, {EXTRACT_SQL} AS sql FROM {LOG_SQL} l")
def sql_text_extract(t):
    """SQL pulled out of model-style answers (fenced, bare fence, plain SELECT, else null)."""
    log = P.query_log(t.orders, t.conversations)
    return P.sql_text_extract(log).select("source", "entry_id", "turn", "sql")


def _guard_sql(s):
    up = f"upper({_trim(s)})"
    parts = [f"WHEN {s} IS NULL OR length({s}) = 0 THEN 'empty'",
             f"WHEN NOT starts_with({up}, 'SELECT') THEN 'not_select'"]
    for kw in P.FORBIDDEN_KEYWORDS:
        parts.append(f"WHEN regexp_matches({up}, '(^|[^A-Z0-9_]){kw}([^A-Z0-9_]|$)') THEN 'forbidden:{kw}'")
    known = " OR ".join(f"contains({up}, '{k}')" for k in P.KNOWN_TABLES)
    parts.append(f"WHEN NOT ({known}) THEN 'no_known_table'")
    return "CASE " + " ".join(parts) + " ELSE 'ok' END"


@query("sql_text_guard", f"""
SELECT source, entry_id, turn, reason, reason = 'ok' AS is_valid FROM (
  SELECT source, entry_id, turn, {_guard_sql('sql')} AS reason
  FROM (SELECT source, entry_id, turn, {EXTRACT_SQL} AS sql FROM {LOG_SQL} l) e) g""")
def sql_text_guard(t):
    """Extracted SQL classified: empty / not_select / forbidden:<kw> / no_known_table / ok."""
    log = P.sql_text_extract(P.query_log(t.orders, t.conversations))
    return P.sql_text_guard(log).select("source", "entry_id", "turn", "reason", "is_valid")


@query("surrogate_key", """
SELECT transaction_id, md5(concat_ws('-', COALESCE(CAST(transaction_id AS VARCHAR), '_null_'),
                                          COALESCE(CAST(customer_id AS VARCHAR), '_null_'),
                                          COALESCE(CAST(transaction_date AS VARCHAR), '_null_'))) AS txn_sk
FROM ord""")
def surrogate_key_q(t):
    """Deterministic null-safe hash key of the business key columns."""
    return FR.ord_frame(t).select(
        "transaction_id", surrogate_key("transaction_id", "customer_id", "transaction_date").alias("txn_sk"))

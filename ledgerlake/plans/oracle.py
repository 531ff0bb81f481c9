"""SQL text of the frames for the independent DuckDB oracle.

The Spark side builds the same frames with the DataFrame API
(``ledgerlake.plans.frames``); these strings are only used to check it.
"""

from __future__ import annotations

FRAMES_WITH = """
WITH ord AS (
  SELECT o_orderkey AS transaction_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         CASE o_orderstatus WHEN 'O' THEN 'COMPLETED' WHEN 'F' THEN 'FAILED' ELSE 'PENDING' END AS status,
         o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS transaction_date,
         o_orderpriority AS payment_method
  FROM orders),
bronze AS (
  SELECT CASE WHEN l_partkey % 50 = 0 THEN NULL
              ELSE CONCAT(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) END AS transaction_id,
         CASE WHEN l_partkey % 53 = 1 THEN -CAST(l_extendedprice AS DECIMAL(18,2))
              WHEN l_partkey % 59 = 2 THEN CAST(0 AS DECIMAL(18,2))
              ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount,
         CASE WHEN l_partkey % 67 = 4 THEN 'APPROVED' ELSE status END AS status,
         l_suppkey AS merchant_id, customer_id,
         CASE WHEN l_partkey % 61 = 3 THEN DATE '2099-12-31' ELSE CAST(l_shipdate AS DATE) END AS transaction_date,
         payment_method, l_shipdate AS ingestion_ts, l_partkey AS tie1, l_quantity AS tie2,
         l_discount AS tie3, l_tax AS tie4, l_returnflag AS return_flag
  FROM lineitem JOIN ord ON l_orderkey = ord.transaction_id),
merch AS (
  SELECT s_suppkey AS merchant_id, s_name AS merchant_name, n_name AS category, r_name AS city
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE s_acctbal >= 0),
silver AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id
             ORDER BY ingestion_ts DESC, tie1, merchant_id, amount, tie2, tie3, tie4, return_flag) AS rn
    FROM bronze WHERE transaction_id IS NOT NULL AND amount >= 0) x
  WHERE rn = 1),
enr AS (
  SELECT s.*, m.merchant_name, m.category, m.city,
         CASE WHEN m.merchant_id IS NULL THEN 'UNMATCHED' ELSE 'CLEAN' END AS quality_flag
  FROM silver s LEFT JOIN merch m ON s.merchant_id = m.merchant_id)
"""


def with_frames(tail: str) -> str:
    """Wrap a query over the frames into one statement DuckDB can run."""
    return FRAMES_WITH + "SELECT * FROM (\n" + tail.strip().rstrip(";") + "\n) AS q"


def pct_sql(num: str, den: str) -> str:
    """``round(100 * num / den, 2)`` as DOUBLE, null when den is 0.

    The quotient goes through DECIMAL so rounding is half-up on the decimal
    value, as Spark's ``round`` is.
    """
    return (f"CAST(ROUND(CAST(100.0 * ({num}) / NULLIF({den}, 0) AS DECIMAL(38,8)), 2) AS DOUBLE)")


def round_sql(expr: str, digits: int = 2) -> str:
    """Half-up rounding of a (possibly double) value: the value is first
    snapped to 8 decimals, which removes binary noise up to magnitude ~1e7."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def money_sql(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"

"""Registered window, sort and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.functions.scalars import MONEY, completed_revenue
from ledgerlake.operators import aggregates as A
from ledgerlake.operators import sets as U
from ledgerlake.operators import windows as WN
from ledgerlake.plans import frames as FR
from ledgerlake.plans.catalog import query
from ledgerlake.plans.oracle import round_sql
from ledgerlake.plans.queries.aggregates import DAILY_SQL, PERF_SQL, REV_SQL

SILVER_COLS = ("transaction_id, amount, status, merchant_id, customer_id, transaction_date, payment_method, "
               "ingestion_ts")
SPARK_SILVER_COLS = [c.strip() for c in SILVER_COLS.split(",")]


@query("dedup_latest", f"SELECT {SILVER_COLS} FROM silver")
def dedup_latest(t):
    """One row per transaction_id, latest ingestion, total tie-break."""
    return FR.silver_frame(t).select(*SPARK_SILVER_COLS)


@query("preferred_method", """
WITH m AS (SELECT customer_id, payment_method, COUNT(*) AS n FROM enr WHERE status = 'COMPLETED' GROUP BY 1, 2)
SELECT customer_id, payment_method AS preferred_payment_method, n FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY n DESC, payment_method) AS rn FROM m) x
WHERE rn = 1""")
def preferred_method(t):
    """Most frequent method per customer (COMPLETED rows), ties by name."""
    return A.preferred_method(FR.enr_frame(t).where(A.is_completed()))


@query("partition_total", """
SELECT transaction_id, customer_id, amount,
       CAST(SUM(CASE WHEN status = 'COMPLETED' THEN amount END) OVER (PARTITION BY customer_id) AS DOUBLE)
         AS customer_lifetime_value
FROM enr""")
def partition_total(t):
    """The customer's COMPLETED total on every row."""
    e = FR.enr_frame(t).select("transaction_id", "customer_id", "amount", "status")
    out = WN.partition_total(e, "customer_id", "amount", F.col("status") == "COMPLETED", "clv")
    return out.select("transaction_id", "customer_id", "amount",
                      F.col("clv").cast("double").alias("customer_lifetime_value"))


@query("dedup_first_seen", f"""
SELECT transaction_id, amount, status, merchant_id, customer_id, transaction_date, payment_method, ingestion_ts
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id
        ORDER BY ingestion_ts, tie1, merchant_id, amount, tie2, tie3, tie4, return_flag) AS rn
      FROM bronze WHERE transaction_id IS NOT NULL) x WHERE rn = 1""")
def dedup_first_seen(t):
    """Keep the first occurrence per id in source order (earliest ingestion, then the tie keys)."""
    b = FR.bronze_frame(t).where(F.col("transaction_id").isNotNull())
    order = [F.col(c) for c in ("ingestion_ts", "tie1", "merchant_id", "amount", "tie2", "tie3", "tie4",
                                "return_flag")]
    return WN.first_per_key(b, "transaction_id", order).select(*SPARK_SILVER_COLS)


@query("surge_vs_other_days", f"""
SELECT report_date, total_revenue, COUNT(*) OVER () AS n_days,
       {round_sql('(SUM(total_revenue) OVER () - total_revenue) / NULLIF(COUNT(*) OVER () - 1, 0)')} AS mean_other_days,
       {round_sql('(total_revenue - (SUM(total_revenue) OVER () - total_revenue) / NULLIF(COUNT(*) OVER () - 1, 0)) * 100 / NULLIF((SUM(total_revenue) OVER () - total_revenue) / NULLIF(COUNT(*) OVER () - 1, 0), 0)')} AS surge_pct
FROM {DAILY_SQL} d""")
def surge_vs_other_days(t):
    """Each day's revenue vs the mean of the other days (window over the daily Gold frame)."""
    return WN.surge_vs_other_days(A.daily_summary(FR.enr_frame(t)))


@query("rank_merchants", f"""
SELECT merchant_id, merchant_name, total_revenue, CAST(RANK() OVER (ORDER BY total_revenue DESC) AS INTEGER) AS revenue_rank
FROM {PERF_SQL} p""")
def rank_merchants(t):
    """Merchants ranked by revenue."""
    p = A.merchant_performance_total(FR.enr_frame(t)).select("merchant_id", "merchant_name", "total_revenue")
    return WN.rank_by(p, "total_revenue")


# ---- sorts, limits, top-k (§2.6) ----

@query("order_by_desc", f"""
SELECT merchant_id, merchant_name, {REV_SQL} AS revenue FROM enr WHERE quality_flag = 'CLEAN'
GROUP BY 1, 2 ORDER BY revenue DESC, merchant_id""")
def order_by_desc(t):
    """Total order on an aggregate (DESC, then the key)."""
    e = FR.enr_frame(t).where(F.col("quality_flag") == "CLEAN")
    return (e.groupBy("merchant_id", "merchant_name").agg(completed_revenue().alias("revenue"))
             .orderBy(F.col("revenue").desc(), "merchant_id"))


@query("top_1", f"""
SELECT merchant_id, merchant_name, {REV_SQL} AS revenue FROM enr WHERE quality_flag = 'CLEAN'
GROUP BY 1, 2 ORDER BY revenue DESC, merchant_id LIMIT 1""")
def top_1(t):
    """The single best merchant (TakeOrderedAndProject)."""
    return order_by_desc(t).limit(1)


@query("top_n", f"""
SELECT customer_id, {REV_SQL} AS revenue FROM enr GROUP BY customer_id
ORDER BY revenue DESC, customer_id LIMIT 10""")
def top_n(t):
    """Top-N customers by revenue with a unique last key."""
    return (FR.enr_frame(t).groupBy("customer_id").agg(completed_revenue().alias("revenue"))
            .orderBy(F.col("revenue").desc(), "customer_id").limit(10))


@query("bounded_preview", f"""
SELECT * FROM {PERF_SQL} p ORDER BY total_revenue DESC, merchant_id LIMIT 20""")
def bounded_preview(t):
    """T4: first 20 rows of a result for display, after a total order."""
    from ledgerlake.operators.sorts import preview
    return preview(A.merchant_performance_total(FR.enr_frame(t)), ["total_revenue", "merchant_id"], [True, False])


# ---- set operations (§2.7) ----

@query("union_all_batches", """
SELECT transaction_id, amount, status, merchant_id, CASE WHEN tie1 % 2 = 0 THEN 'clean' ELSE 'dirty' END AS batch
FROM bronze""")
def union_all_batches(t):
    """Clean + dirty batches (split by part key parity) as a bag union."""
    b = FR.bronze_frame(t).select("transaction_id", "amount", "status", "merchant_id", "tie1")
    clean = b.where(F.col("tie1") % 2 == 0).withColumn("batch", F.lit("clean"))
    dirty = b.where(F.col("tie1") % 2 != 0).withColumn("batch", F.lit("dirty"))
    return U.union_batches(clean, dirty).drop("tie1")


DIFF_COLS = ["transaction_id", "amount", "status", "merchant_id", "customer_id", "transaction_date",
             "payment_method"]


def _diff_sql(a, b):
    def long(src, side):
        return " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, {side} AS side FROM {src} WHERE {c} IS NOT NULL"
            for c in DIFF_COLS)
    return f"""
WITH l AS ({long(a, 1)} UNION ALL {long(b, 2)}),
v AS (SELECT column_name, value, BIT_OR(side) AS sides FROM l GROUP BY 1, 2)
SELECT column_name, COUNT(*) FILTER (WHERE sides = 1) AS only_in_a, COUNT(*) FILTER (WHERE sides = 2) AS only_in_b,
       COUNT(*) FILTER (WHERE sides = 3) AS in_both,
       (COUNT(*) FILTER (WHERE sides = 1) + COUNT(*) FILTER (WHERE sides = 2)) > 0 AS drifted
FROM v GROUP BY column_name"""


@query("distinct_value_diff", _diff_sql("bronze", "enr"))
def distinct_value_diff(t):
    """Per column, distinct values in Bronze not in enriched Silver and back."""
    return U.distinct_value_diff(FR.bronze_frame(t), FR.enr_frame(t), DIFF_COLS)


VERSION_SQL = """
SELECT transaction_id, amount, status, merchant_id, transaction_date,
       CAST(NULL AS BIGINT) AS customer_id, CAST(NULL AS VARCHAR) AS payment_method, 'v1' AS schema_version
FROM silver WHERE transaction_date < DATE '1997-01-01'
UNION ALL
SELECT transaction_id, amount, status, merchant_id, transaction_date, customer_id, payment_method, 'v2'
FROM silver WHERE transaction_date >= DATE '1997-01-01' AND transaction_date < DATE '2000-01-01'
UNION ALL
SELECT transaction_id, amount, status, merchant_id, transaction_date, customer_id, NULL, 'v3'
FROM silver WHERE transaction_date >= DATE '2000-01-01'"""


def schema_versions(t, silver=None):
    """Three schema versions of Silver sliced by date: v1 has 5 columns, v2
    adds customer_id and payment_method, v3 renames customer_id to user_id
    and drops payment_method."""
    s = FR.silver_frame(t) if silver is None else silver
    d = F.col("transaction_date")
    v1 = s.where(d < F.lit("1997-01-01").cast("date")).select(
        "transaction_id", "amount", "status", "merchant_id", "transaction_date")
    v2 = s.where((d >= F.lit("1997-01-01").cast("date")) & (d < F.lit("2000-01-01").cast("date"))).select(
        "transaction_id", "amount", "status", "merchant_id", "transaction_date", "customer_id", "payment_method")
    v3 = s.where(d >= F.lit("2000-01-01").cast("date")).select(
        "transaction_id", "amount", "status", "merchant_id", "transaction_date",
        F.col("customer_id").alias("user_id"))
    return {"v1": v1, "v2": v2, "v3": v3}


VERSION_FIELDS = ["transaction_id", "amount", "status", "merchant_id", "transaction_date"]
VERSION_TYPES = {"transaction_id": "string", "amount": "decimal(18,2)", "status": "string", "merchant_id": "bigint", "transaction_date": "date",
                 "customer_id": "bigint", "payment_method": "string"}


def versioned_rows(t):
    """The versions of schema_versions() as rows of one frame, each with its own fields."""
    d, first, second = F.col("transaction_date"), F.lit("1997-01-01").cast("date"), F.lit("2000-01-01").cast("date")
    own = {c: c for c in VERSION_FIELDS}
    return U.with_versions(FR.silver_frame(t), {
        "v1": (d < first, own), "v2": ((d >= first) & (d < second), own | {"customer_id": "customer_id", "payment_method": "payment_method"}),
        "v3": (d >= second, own | {"user_id": "customer_id"})})


@query("schema_version_union", VERSION_SQL)
def schema_version_union(t):
    """v1 ∪ v2 ∪ v3 with user_id mapped back to customer_id and missing columns null, from one pass over Silver."""
    return U.align_variants(versioned_rows(t), VERSION_TYPES, {"user_id": "customer_id"})


@query("layer_row_delta", """
WITH c AS (SELECT COUNT(*) FILTER (WHERE transaction_id IS NULL) AS null_id,
                  COUNT(*) FILTER (WHERE transaction_id IS NOT NULL AND amount < 0) AS negative_amount,
                  COUNT(*) FILTER (WHERE transaction_id IS NOT NULL AND amount >= 0) AS valid,
                  COUNT(DISTINCT transaction_id) FILTER (WHERE amount >= 0) AS kept
           FROM bronze)
SELECT 'null_id' AS reason, null_id AS rows FROM c
UNION ALL SELECT 'negative_amount', negative_amount FROM c
UNION ALL SELECT 'duplicate', valid - kept FROM c
UNION ALL SELECT 'kept', kept FROM c""")
def layer_row_delta(t):
    """U4: rows dropped between Bronze and Silver by reason (null id, negative
    amount, duplicate) and the rows kept; they add up to Bronze. One aggregate
    pass — no per-id window, so a hot id or a flood of null ids costs nothing."""
    return U.layer_row_delta(FR.bronze_frame(t))


COMMON_EXCLUDE = ("ingestion_ts", "tie1", "tie2", "tie3", "tie4", "return_flag")


@query("common_columns", """
SELECT 'bronze' AS layer, COUNT(*) AS rows, 7 AS n_columns FROM bronze
UNION ALL SELECT 'silver', COUNT(*), 7 FROM enr""")
def common_columns(t):
    """The columns both layers share (minus provenance/tie columns), then
    one union of both layers on exactly those columns, counted per layer."""
    b, e = FR.bronze_frame(t), FR.enr_frame(t)
    cols = U.common_columns(b, e, exclude=COMMON_EXCLUDE + ("rn",))
    u = b.select(*cols).withColumn("layer", F.lit("bronze")).unionByName(
        e.select(*cols).withColumn("layer", F.lit("silver")))
    return u.groupBy("layer").agg(F.count(F.lit(1)).alias("rows")).withColumn("n_columns", F.lit(len(cols)))

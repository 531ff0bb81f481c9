"""Registered aggregation queries over the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerlake.functions.scalars import (MONEY, completed_revenue, count_when, failure_pct,
                                          pct, round2)
from ledgerlake.operators import aggregates as A
from ledgerlake.operators import semantic as S
from ledgerlake.plans import frames as FR
from ledgerlake.plans.catalog import query
from ledgerlake.plans.oracle import pct_sql, round_sql

# Fixed parameters of the registered queries (the reference's questions,
# re-scaled to the driver data's amount range where noted).
ANCHOR = FR.ANCHOR_DATE                 # "today" of every report
LTV_MIN_REVENUE = 1000                  # A8 HAVING bound
SUSPICIOUS_MIN_TXNS = 2                 # A26: count >= 2 ...
SUSPICIOUS_MAX_AVG = 50000              # ... and avg below this (reference 1500 on ~1000-sized amounts;
                                        # here the lower tail of per-merchant means, ~52k median)
REVIEW_THRESHOLD = 50000                # P11 / A27 compliance threshold
CHURN_DAYS = 14                         # A30 at-risk window
RISK_RATE = 30                          # A31 suspicious failure %
SEGMENT_DAYS = 30                       # A32 spend window
SEGMENT_VIP, SEGMENT_HIGH, SEGMENT_MID = 500000, 200000, 20000  # A32 tiers (x100 of 5000/2000/200)
MANY_FAILURES = 3                       # A34
TREND_METHOD = "1-URGENT"               # A35 the one method
RECENT_DAYS, RECENT_RATE = 7, 20        # A36
TOP5_MONTH = dt.date(2001, 7, 1)        # A37 month

REV_SQL = "CAST(COALESCE(SUM(CASE WHEN status = 'COMPLETED' THEN amount END), 0) AS DOUBLE)"
FAILED_SQL = "COUNT(*) FILTER (WHERE status = 'FAILED')"
FAIL_SQL = pct_sql(FAILED_SQL, "COUNT(*)")


def clean_enr(t):
    """Fact ⋈ merchant (inner): the transactions that have a merchant name."""
    return FR.enr_frame(t).where(F.col("quality_flag") == "CLEAN")


@query("merchant_performance_total", f"""
SELECT merchant_id, COALESCE(merchant_name, '') AS merchant_name,
       COALESCE(category, '') AS category, COALESCE(city, '') AS city,
       {REV_SQL} AS total_revenue, COUNT(*) AS txn_count, {FAIL_SQL} AS failure_rate_pct
FROM enr GROUP BY 1, 2, 3, 4""")
def merchant_performance_total(t):
    """Revenue, count and failure rate per merchant (the flagship)."""
    return A.merchant_performance_total(FR.enr_frame(t))


@query("total_count", "SELECT COUNT(*) AS total_count FROM enr")
def total_count(t):
    """A1: COUNT(*)."""
    return FR.enr_frame(t).agg(F.count(F.lit(1)).alias("total_count"))


@query("failed_count", "SELECT COUNT(*) AS failed_count FROM enr WHERE status = 'FAILED'")
def failed_count(t):
    """A2: count of FAILED."""
    return FR.enr_frame(t).where(A.is_failed()).agg(F.count(F.lit(1)).alias("failed_count"))


@query("total_revenue", f"SELECT {REV_SQL} AS total_revenue FROM enr")
def total_revenue(t):
    """A3: COMPLETED revenue over all rows."""
    return FR.enr_frame(t).agg(completed_revenue().alias("total_revenue"))


@query("completed_count", "SELECT COUNT(*) FILTER (WHERE status = 'COMPLETED') AS completed_count FROM enr")
def completed_count(t):
    """A4: conditional count."""
    return FR.enr_frame(t).agg(count_when(A.is_completed()).alias("completed_count"))


@query("failure_rate_by_method", f"""
SELECT payment_method, COUNT(*) AS total_txns, {FAILED_SQL} AS failed_txns,
       {FAIL_SQL} AS failure_rate_pct
FROM enr GROUP BY payment_method""")
def failure_rate_by_method(t):
    """A5: total, failed, failure % per payment method."""
    return A.failure_rate_by(FR.enr_frame(t), "payment_method")


@query("revenue_by_merchant", f"""
SELECT merchant_name, {REV_SQL} AS revenue FROM enr WHERE quality_flag = 'CLEAN'
GROUP BY merchant_name""")
def revenue_by_merchant(t):
    """Revenue per merchant name (fact ⋈ merchant)."""
    return clean_enr(t).groupBy("merchant_name").agg(completed_revenue().alias("revenue"))


@query("top_merchants", f"""
SELECT merchant_id, merchant_name, CAST(SUM(amount) AS DOUBLE) AS total_revenue, COUNT(*) AS txn_count
FROM enr WHERE quality_flag = 'CLEAN' AND status = 'COMPLETED' AND transaction_date > DATE '1995-01-01'
GROUP BY merchant_id, merchant_name ORDER BY total_revenue DESC, merchant_id LIMIT 10""")
def top_merchants(t):
    """The corrected top-10: COMPLETED only, explicit join, DESC, unique tie key."""
    e = clean_enr(t).where(A.is_completed() & (F.col("transaction_date") > F.lit(dt.date(1995, 1, 1))))
    return (e.groupBy("merchant_id", "merchant_name")
             .agg(F.sum(F.col("amount").cast(MONEY)).cast("double").alias("total_revenue"),
                  F.count(F.lit(1)).alias("txn_count"))
             .orderBy(F.col("total_revenue").desc(), "merchant_id").limit(10))


@query("customer_lifetime_value", f"""
SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, c.c_mktsegment AS tier,
       CAST(COALESCE(SUM(o.amount), 0) AS DOUBLE) AS revenue, COUNT(o.transaction_id) AS total_orders
FROM customer c LEFT JOIN ord o ON c.c_custkey = o.customer_id AND o.status = 'COMPLETED'
GROUP BY 1, 2, 3 HAVING COALESCE(SUM(o.amount), 0) > {LTV_MIN_REVENUE}""")
def customer_lifetime_value(t):
    """Revenue and orders per customer, HAVING revenue > 1000; the
    status test sits in the join condition (J5), not in WHERE."""
    from ledgerlake.operators.joins import left_join_on_predicate
    j = left_join_on_predicate(t.customer, FR.ord_frame(t))
    return (j.groupBy(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
                      F.col("c_mktsegment").alias("tier"))
             .agg(F.coalesce(F.sum("amount"), F.lit(0).cast(MONEY)).alias("rev"),
                  F.count("transaction_id").alias("total_orders"))
             .where(F.col("rev") > LTV_MIN_REVENUE)
             .select("customer_id", "customer_name", "tier",
                     F.col("rev").cast("double").alias("revenue"), "total_orders"))


@query("daily_failure_rate", f"""
SELECT transaction_date, {FAILED_SQL} AS failed_count, COUNT(*) AS total_count,
       {FAIL_SQL} AS failure_rate
FROM ord GROUP BY transaction_date""")
def daily_failure_rate(t):
    """A9 (= J8 decorrelated): failed, total and rate per day, one pass."""
    return (FR.ord_frame(t).groupBy("transaction_date")
            .agg(count_when(A.is_failed()).alias("failed_count"),
                 F.count(F.lit(1)).alias("total_count"),
                 failure_pct().alias("failure_rate")))


@query("tier_summary", f"""
SELECT c.c_mktsegment AS tier, COUNT(*) AS transaction_count,
       COUNT(DISTINCT o.customer_id) AS unique_customers,
       {round_sql('AVG(o.amount)')} AS avg_transaction_amount
FROM ord o JOIN customer c ON o.customer_id = c.c_custkey
WHERE o.status = 'COMPLETED' GROUP BY c.c_mktsegment""")
def tier_summary(t):
    """A10: count, distinct customers and mean amount per tier (market segment)."""
    o = FR.ord_frame(t).where(A.is_completed())
    c = t.customer.select("c_custkey", "c_mktsegment")
    return (o.join(c, o.customer_id == c.c_custkey)
             .groupBy(F.col("c_mktsegment").alias("tier"))
             .agg(F.count(F.lit(1)).alias("transaction_count"),
                  F.count_distinct("customer_id").alias("unique_customers"),
                  round2(F.avg("amount")).alias("avg_transaction_amount")))


@query("merchant_performance", f"""
SELECT merchant_id, merchant_name, category, city, transaction_date AS report_date,
       {REV_SQL} AS total_revenue, COUNT(*) AS txn_count, {FAIL_SQL} AS failure_rate_pct
FROM enr GROUP BY 1, 2, 3, 4, 5""")
def merchant_performance(t):
    """Gold merchant_performance per merchant and day."""
    return A.merchant_performance(FR.enr_frame(t))


@query("customer_ltv", f"""
WITH done AS (SELECT * FROM enr WHERE status = 'COMPLETED'),
m AS (SELECT customer_id, payment_method, COUNT(*) AS n FROM done GROUP BY 1, 2),
pm AS (SELECT customer_id, payment_method FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY n DESC, payment_method) AS rn FROM m) x
       WHERE rn = 1)
SELECT d.customer_id, CAST(SUM(amount) AS DOUBLE) AS total_spent, COUNT(*) AS total_txns,
       {round_sql('AVG(amount)')} AS avg_txn_value, MIN(transaction_date) AS first_txn_date,
       MAX(transaction_date) AS last_txn_date, ANY_VALUE(pm.payment_method) AS preferred_payment_method
FROM done d JOIN pm ON d.customer_id = pm.customer_id GROUP BY d.customer_id""")
def customer_ltv(t):
    """Gold customer_ltv with the preferred payment method."""
    return A.customer_ltv(FR.enr_frame(t))


@query("daily_summary", f"""
SELECT transaction_date AS report_date, {REV_SQL} AS total_revenue, COUNT(*) AS total_txns,
       COUNT(DISTINCT customer_id) AS unique_customers, COUNT(DISTINCT merchant_id) AS unique_merchants,
       {FAIL_SQL} AS failure_rate_pct
FROM enr GROUP BY transaction_date""")
def daily_summary(t):
    """Gold daily_summary."""
    return A.daily_summary(FR.enr_frame(t))


MART_SQL = f"""
WITH am AS (
  SELECT merchant_id, COUNT(transaction_id) AS total_transactions,
         COUNT(*) FILTER (WHERE status = 'COMPLETED') AS completed_transactions,
         {FAILED_SQL} AS failed_transactions, {REV_SQL} AS total_revenue,
         {round_sql("AVG(CASE WHEN status = 'COMPLETED' THEN amount END)")} AS avg_completed_value,
         COUNT(DISTINCT customer_id) AS unique_customers, {FAIL_SQL} AS failure_rate_pct
  FROM silver WHERE status IN ('COMPLETED', 'FAILED') GROUP BY merchant_id)
SELECT am.*, md.merchant_name, md.category, md.city FROM am JOIN merch md ON am.merchant_id = md.merchant_id"""


@query("mart_merchant_performance", MART_SQL)
def mart_merchant_performance(t):
    """The merchant mart (COMPLETED and FAILED rows), aggregated then joined to merchants."""
    return A.mart_merchant_performance(FR.silver_frame(t).drop("rn"), FR.merch_frame(t))


@query("merchant_daily_metrics", f"""
SELECT transaction_date AS metric_date, merchant_id, COUNT(*) AS total_transactions,
       CAST(SUM(amount) AS DOUBLE) AS total_amount, {FAILED_SQL} AS failed_count,
       {round_sql('AVG(amount)')} AS avg_transaction_value
FROM enr GROUP BY 1, 2""")
def merchant_daily_metrics(t):
    """The daily aggregate fact keyed by (metric_date, merchant_id)."""
    return (FR.enr_frame(t).groupBy(F.col("transaction_date").alias("metric_date"), "merchant_id")
            .agg(F.count(F.lit(1)).alias("total_transactions"),
                 F.sum("amount").cast("double").alias("total_amount"),
                 count_when(A.is_failed()).alias("failed_count"),
                 round2(F.avg("amount")).alias("avg_transaction_value")))


PERF_SQL = f"""(SELECT merchant_id, COALESCE(merchant_name, '') AS merchant_name,
       COALESCE(category, '') AS category, COALESCE(city, '') AS city,
       {REV_SQL} AS total_revenue, COUNT(*) AS txn_count, {FAIL_SQL} AS failure_rate_pct
FROM enr GROUP BY 1, 2, 3, 4)"""


def perf(t):
    return A.merchant_performance_total(FR.enr_frame(t))


@query("category_revenue", f"""
SELECT category, {round_sql('SUM(total_revenue)')} AS total_rev, CAST(SUM(txn_count) AS BIGINT) AS total_txns,
       {round_sql('AVG(total_revenue)')} AS avg_rev_per_merchant
FROM {PERF_SQL} p GROUP BY category""")
def category_revenue(t):
    """Per category over the merchant Gold table (aggregate of an aggregate)."""
    return (perf(t).groupBy("category")
            .agg(round2(F.sum("total_revenue")).alias("total_rev"),
                 F.sum("txn_count").alias("total_txns"),
                 round2(F.avg("total_revenue")).alias("avg_rev_per_merchant")))


DAILY_SQL = f"""(SELECT transaction_date AS report_date, {REV_SQL} AS total_revenue, COUNT(*) AS total_txns,
       COUNT(DISTINCT customer_id) AS unique_customers, COUNT(DISTINCT merchant_id) AS unique_merchants,
       {FAIL_SQL} AS failure_rate_pct FROM enr GROUP BY transaction_date)"""


@query("gold_kpi_summary", f"""
SELECT {round_sql('SUM(total_revenue)')} AS total_rev, CAST(SUM(total_txns) AS BIGINT) AS total_txns,
       {round_sql('AVG(failure_rate_pct)')} AS avg_fail_pct,
       MIN(total_revenue) AS min_day_rev, MAX(total_revenue) AS max_day_rev
FROM {DAILY_SQL} d""")
def gold_kpi_summary(t):
    """Global KPIs over daily Gold; the failure % is the unweighted day mean."""
    d = A.daily_summary(FR.enr_frame(t))
    return d.agg(round2(F.sum("total_revenue")).alias("total_rev"),
                 F.sum("total_txns").alias("total_txns"),
                 round2(F.avg("failure_rate_pct")).alias("avg_fail_pct"),
                 F.min("total_revenue").alias("min_day_rev"),
                 F.max("total_revenue").alias("max_day_rev"))


@query("gold_health_stats", f"""
SELECT COUNT(*) AS merchants, {round_sql('SUM(total_revenue)')} AS total_revenue,
       {round_sql('AVG(failure_rate_pct)')} AS avg_failure_rate_pct, MAX(failure_rate_pct) AS max_failure_rate_pct,
       (SELECT merchant_id FROM {PERF_SQL} p2 ORDER BY failure_rate_pct DESC, merchant_id LIMIT 1) AS worst_merchant_id
FROM {PERF_SQL} p""")
def gold_health_stats(t):
    """Merchants, revenue, mean/max failure % and the merchant at the max
    (ties to the lowest id) — one aggregate, ``min_by`` over a sort struct."""
    p = perf(t)
    return p.agg(F.count(F.lit(1)).alias("merchants"),
                 round2(F.sum("total_revenue")).alias("total_revenue"),
                 round2(F.avg("failure_rate_pct")).alias("avg_failure_rate_pct"),
                 F.max("failure_rate_pct").alias("max_failure_rate_pct"),
                 F.min_by("merchant_id", F.struct(-F.col("failure_rate_pct"), F.col("merchant_id")))
                  .alias("worst_merchant_id"))


@query("status_breakdown", """
SELECT status, COUNT(*) AS txn_count, COUNT(*) OVER () AS distinct_statuses
FROM enr GROUP BY status""")
def status_breakdown(t):
    """Rows per status and the number of distinct statuses (window over
    the already-aggregated handful of rows)."""
    return (FR.enr_frame(t).groupBy("status").agg(F.count(F.lit(1)).alias("txn_count"))
            .withColumn("distinct_statuses", F.count(F.lit(1)).over(W.partitionBy())))


@query("avg_amount_by_merchant", f"""
SELECT merchant_id, COUNT(*) AS n, {round_sql('AVG(amount)')} AS avg_amount
FROM bronze WHERE amount > 0 GROUP BY merchant_id""")
def avg_amount_by_merchant(t):
    """Mean of positive amounts per merchant on raw Bronze."""
    return A.avg_amount_by_merchant(FR.bronze_frame(t))


@query("merchant_summary_full", f"""
SELECT merchant_name, category, COUNT(transaction_id) AS total_txns,
       COUNT(*) FILTER (WHERE status = 'COMPLETED') AS completed, {FAILED_SQL} AS failed,
       {FAIL_SQL} AS failure_rate_pct, {REV_SQL} AS revenue_usd
FROM enr WHERE quality_flag = 'CLEAN' GROUP BY merchant_name, category""")
def merchant_summary_full(t):
    """The verified full performance summary per merchant."""
    return (clean_enr(t).groupBy("merchant_name", "category")
            .agg(F.count("transaction_id").alias("total_txns"),
                 count_when(A.is_completed()).alias("completed"),
                 count_when(A.is_failed()).alias("failed"),
                 failure_pct().alias("failure_rate_pct"),
                 completed_revenue().alias("revenue_usd")))


@query("failed_txn_backcalc", f"""
SELECT merchant_name, txn_count, failure_rate_pct,
       CAST(ROUND(CAST(txn_count * failure_rate_pct / 100 AS DECIMAL(38,10)), 0) AS DOUBLE) AS failed_txns
FROM {PERF_SQL} p WHERE failure_rate_pct > 0""")
def failed_txn_backcalc(t):
    """Failed count re-derived as count × rate / 100 for merchants with failures."""
    return (perf(t).where(F.col("failure_rate_pct") > 0)
            .select("merchant_name", "txn_count", "failure_rate_pct",
                    F.round(F.col("txn_count") * F.col("failure_rate_pct") / 100, 0).cast("double")
                     .alias("failed_txns")))


@query("method_growth_mom", f"""
WITH m AS (SELECT payment_method, DATE_TRUNC('month', transaction_date) AS month, COUNT(*) AS n
           FROM ord WHERE payment_method IS NOT NULL AND amount IS NOT NULL GROUP BY 1, 2)
SELECT cur.payment_method, CAST(cur.month AS DATE) AS month, cur.n AS txns, prev.n AS prev_txns,
       COALESCE({round_sql('(cur.n / NULLIF(prev.n, 0) - 1) * 100.0')}, 0) AS growth_pct
FROM m cur LEFT JOIN m prev ON cur.payment_method = prev.payment_method
 AND prev.month = cur.month - INTERVAL 1 MONTH""")
def method_growth_mom(t):
    """Month-over-month growth % per payment method for every month,
    null-safe (no previous month or zero -> 0)."""
    o = FR.ord_frame(t).where(F.col("payment_method").isNotNull() & F.col("amount").isNotNull())
    m = (o.groupBy("payment_method", F.trunc("transaction_date", "month").alias("month"))
          .agg(F.count(F.lit(1)).alias("n")))
    prev = m.select(F.col("payment_method").alias("pm"), F.add_months("month", 1).alias("next_month"),
                    F.col("n").alias("prev_txns"))
    j = m.join(prev, (m.payment_method == prev.pm) & (m.month == prev.next_month), "left")
    growth = (F.try_divide(F.col("n").cast("double"), F.nullif(F.col("prev_txns"), F.lit(0))) - 1) * 100.0
    return j.select("payment_method", "month", F.col("n").alias("txns"), "prev_txns",
                    F.coalesce(round2(growth), F.lit(0.0)).alias("growth_pct"))


@query("refund_rate_top5", f"""
SELECT merchant_id, merchant_name,
       COUNT(DISTINCT CASE WHEN return_flag = 'R' THEN transaction_id END) AS refund_count,
       COUNT(DISTINCT transaction_id) AS total_transaction_count,
       COALESCE({pct_sql("COUNT(DISTINCT CASE WHEN return_flag = 'R' THEN transaction_id END)",
                         "COUNT(DISTINCT transaction_id)")}, 0) AS refund_rate
FROM enr WHERE quality_flag = 'CLEAN'
  AND transaction_date BETWEEN DATE_TRUNC('year', DATE '{ANCHOR}') AND DATE '{ANCHOR}'
GROUP BY merchant_id, merchant_name ORDER BY refund_rate DESC, merchant_id LIMIT 5""")
def refund_rate_top5(t):
    """Refund rate per merchant this year, top 5 (X19 fixed: the status
    test lives only inside the conditional distinct count)."""
    e = clean_enr(t).where(F.col("transaction_date").between(
        F.trunc(F.lit(ANCHOR), "year"), F.lit(ANCHOR)))
    refunds = F.count_distinct(F.when(F.col("return_flag") == "R", F.col("transaction_id")))
    total = F.count_distinct("transaction_id")
    return (e.groupBy("merchant_id", "merchant_name")
             .agg(refunds.alias("refund_count"), total.alias("total_transaction_count"),
                  F.coalesce(pct(refunds, total), F.lit(0.0)).alias("refund_rate"))
             .orderBy(F.col("refund_rate").desc(), "merchant_id").limit(5))


@query("suspicious_having", f"""
SELECT merchant_id, COUNT(*) AS txn_count, {round_sql('AVG(amount)')} AS avg_amount
FROM enr GROUP BY merchant_id
HAVING COUNT(*) >= {SUSPICIOUS_MIN_TXNS} AND AVG(amount) < {SUSPICIOUS_MAX_AVG}""")
def suspicious_having(t):
    """Merchants with at least 2 transactions and a low mean amount."""
    return A.suspicious_merchants(FR.enr_frame(t), SUSPICIOUS_MIN_TXNS, SUSPICIOUS_MAX_AVG)


@query("compliance_daily_summary", f"""
SELECT transaction_date, payment_method, CAST(SUM(amount) AS DOUBLE) AS total_amount, COUNT(*) AS txn_count,
       COUNT(*) FILTER (WHERE amount > {REVIEW_THRESHOLD}) AS review_count,
       COUNT(*) FILTER (WHERE quality_flag = 'CLEAN') AS clean_count,
       COUNT(*) FILTER (WHERE quality_flag = 'UNMATCHED') AS unmatched_count,
       TIMESTAMP '{ANCHOR} 00:00:00' AS generated_at
FROM enr GROUP BY 1, 2""")
def compliance_daily_summary(t):
    """Per day × method: amount, count, count requiring review (P11),
    quality-flag distribution and the report stamp."""
    from ledgerlake.operators.filters import compliance_flag
    e = compliance_flag(FR.enr_frame(t), REVIEW_THRESHOLD)
    return (e.groupBy("transaction_date", "payment_method")
             .agg(F.sum("amount").cast("double").alias("total_amount"),
                  F.count(F.lit(1)).alias("txn_count"),
                  count_when(F.col("requires_review")).alias("review_count"),
                  count_when(F.col("quality_flag") == "CLEAN").alias("clean_count"),
                  count_when(F.col("quality_flag") == "UNMATCHED").alias("unmatched_count"))
             .withColumn("generated_at", F.lit(dt.datetime(ANCHOR.year, ANCHOR.month, ANCHOR.day))
                         .cast("timestamp_ntz")))


def _fee_sql_values():
    from ledgerlake.operators.joins import FEE_RATES
    rows = ", ".join(f"('{k}', {v})" for k, v in FEE_RATES.items())
    return f"(VALUES {rows}) AS f(payment_method, fee_rate)"


@query("fee_analysis", f"""
SELECT e.transaction_date, e.payment_method, COUNT(*) AS txn_count, CAST(SUM(e.amount) AS DOUBLE) AS gross_amount,
       {round_sql('SUM(e.amount * (1 - f.fee_rate))')} AS effective_revenue
FROM enr e JOIN {_fee_sql_values()} ON e.payment_method = f.payment_method
WHERE e.status = 'COMPLETED' GROUP BY 1, 2""")
def fee_analysis(t):
    """Volume and effective revenue (after the method's fee) per day and method."""
    from ledgerlake.operators.joins import fee_lookup_join
    e = fee_lookup_join(FR.enr_frame(t).where(A.is_completed()))
    return (e.groupBy("transaction_date", "payment_method")
             .agg(F.count(F.lit(1)).alias("txn_count"),
                  F.sum("amount").cast("double").alias("gross_amount"),
                  round2(F.sum("effective_amount")).alias("effective_revenue")))


PROMO_SQL = """(SELECT c_custkey AS customer_id, c_custkey AS promo_id,
        CASE (c_custkey % 9) // 3 WHEN 0 THEN 'Email' WHEN 1 THEN 'SMS' ELSE 'Push' END AS channel,
        CAST(5 * (1 + c_custkey % 4) AS DECIMAL(5,2)) AS discount_pct
   FROM customer WHERE c_custkey % 3 = 0)"""


@query("marketing_attribution", f"""
SELECT p.channel, COUNT(DISTINCT e.customer_id) AS customers, COUNT(*) AS txn_count,
       CAST(SUM(e.amount) AS DOUBLE) AS revenue_per_channel,
       {round_sql('SUM(e.amount * p.discount_pct / 100)')} AS discount_cost,
       {round_sql('SUM(e.amount) / NULLIF(SUM(e.amount * p.discount_pct / 100), 0)', 4)} AS roi_per_channel
FROM enr e JOIN {PROMO_SQL} p ON e.customer_id = p.customer_id
WHERE e.status = 'COMPLETED' GROUP BY p.channel""")
def marketing_attribution(t):
    """A29 (J13): revenue per promotion channel and ROI = revenue / discount cost."""
    from ledgerlake.operators.joins import promo_attribution_join, promotions
    e = promo_attribution_join(FR.enr_frame(t).where(A.is_completed()), promotions(t.customer))
    return (e.groupBy("channel")
             .agg(F.count_distinct("customer_id").alias("customers"),
                  F.count(F.lit(1)).alias("txn_count"),
                  F.sum("amount").cast("double").alias("revenue_per_channel"),
                  F.sum("discount_cost").alias("dc"),
                  F.sum("amount").alias("rev"))
             .select("channel", "customers", "txn_count", "revenue_per_channel",
                     round2("dc").alias("discount_cost"),
                     round2(F.try_divide(F.col("rev"), F.nullif(F.col("dc"), F.lit(0))), 4).alias("roi_per_channel")))


@query("rfm_churn", f"""
SELECT customer_id, CAST(DATE_DIFF('day', MAX(transaction_date), DATE '{ANCHOR}') AS INTEGER) AS recency_days,
       COUNT(*) AS frequency, {REV_SQL} AS monetary,
       DATE_DIFF('day', MAX(transaction_date), DATE '{ANCHOR}') > {CHURN_DAYS} AS at_risk
FROM enr GROUP BY customer_id""")
def rfm_churn(t):
    """Recency (days to the anchor), frequency, monetary per customer;
    at risk when the last transaction is more than 14 days old."""
    return A.rfm(FR.enr_frame(t), ANCHOR, CHURN_DAYS)


@query("merchant_risk_scores", f"""
SELECT merchant_id, transaction_date, COUNT(*) AS txn_count, {FAILED_SQL} AS failed_count,
       {FAIL_SQL} AS failure_rate_pct, {FAIL_SQL} > {RISK_RATE} AS suspicious,
       CASE WHEN COUNT(*) <= 1 THEN 'LOW' WHEN COUNT(*) <= 2 THEN 'MEDIUM' ELSE 'HIGH' END AS confidence_level
FROM enr GROUP BY 1, 2""")
def merchant_risk_scores(t):
    """Daily failure rate per merchant, suspicious above 30 %, confidence
    from the sample size (1 -> LOW, 2 -> MEDIUM, more -> HIGH; our definition
    after the reference's single/tiny-sample thresholds)."""
    return A.merchant_risk(FR.enr_frame(t), RISK_RATE)


@query("customer_segments", f"""
SELECT customer_id, {REV_SQL} AS spend_30d,
       CASE WHEN {REV_SQL} > {SEGMENT_VIP} THEN 'VIP' WHEN {REV_SQL} > {SEGMENT_HIGH} THEN 'High'
            WHEN {REV_SQL} >= {SEGMENT_MID} THEN 'Mid' ELSE 'Low' END AS segment
FROM enr WHERE transaction_date > DATE '{ANCHOR}' - INTERVAL {SEGMENT_DAYS} DAY AND transaction_date <= DATE '{ANCHOR}'
GROUP BY customer_id""")
def customer_segments(t):
    """30-day COMPLETED spend per customer -> VIP / High / Mid / Low."""
    return A.customer_segments(FR.enr_frame(t), ANCHOR, SEGMENT_DAYS, SEGMENT_VIP, SEGMENT_HIGH, SEGMENT_MID)


@query("avg_value_by_method", f"""
SELECT payment_method, {round_sql('AVG(amount)')} AS avg_completed_value
FROM enr WHERE status = 'COMPLETED' GROUP BY payment_method""")
def avg_value_by_method(t):
    """Mean COMPLETED value per payment method."""
    return (FR.enr_frame(t).where(A.is_completed()).groupBy("payment_method")
            .agg(round2(F.avg("amount")).alias("avg_completed_value")))


@query("customers_many_failures", f"""
SELECT customer_id, COUNT(*) AS failed_count FROM enr WHERE status = 'FAILED'
GROUP BY customer_id HAVING COUNT(*) > {MANY_FAILURES}""")
def customers_many_failures(t):
    """Customers with more than 3 failed transactions."""
    return (FR.enr_frame(t).where(A.is_failed()).groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("failed_count"))
            .where(F.col("failed_count") > MANY_FAILURES))


@query("daily_count_trend_method", f"""
SELECT transaction_date, COUNT(*) AS txn_count FROM enr WHERE payment_method = '{TREND_METHOD}'
GROUP BY transaction_date""")
def daily_count_trend_method(t):
    """Daily transaction count for one payment method."""
    return (FR.enr_frame(t).where(F.col("payment_method") == TREND_METHOD)
            .groupBy("transaction_date").agg(F.count(F.lit(1)).alias("txn_count")))


@query("recent_failure_merchants", f"""
SELECT merchant_id, COUNT(*) AS txn_count, {FAIL_SQL} AS failure_rate_pct
FROM enr WHERE transaction_date > DATE '{ANCHOR}' - INTERVAL {RECENT_DAYS} DAY AND transaction_date <= DATE '{ANCHOR}'
GROUP BY merchant_id HAVING {FAIL_SQL} > {RECENT_RATE}""")
def recent_failure_merchants(t):
    """Merchants with failure rate above 20 % in the last 7 days."""
    e = FR.enr_frame(t).where((F.col("transaction_date") > F.date_sub(F.lit(ANCHOR), RECENT_DAYS))
                              & (F.col("transaction_date") <= F.lit(ANCHOR)))
    return (e.groupBy("merchant_id")
             .agg(F.count(F.lit(1)).alias("txn_count"), failure_pct().alias("failure_rate_pct"))
             .where(F.col("failure_rate_pct") > RECENT_RATE))


@query("top5_in_month", f"""
SELECT merchant_id, merchant_name, {REV_SQL} AS revenue
FROM enr WHERE quality_flag = 'CLEAN' AND DATE_TRUNC('month', transaction_date) = DATE '{TOP5_MONTH}'
GROUP BY merchant_id, merchant_name ORDER BY revenue DESC, merchant_id LIMIT 5""")
def top5_in_month(t):
    """Top 5 merchants by revenue in one month."""
    e = clean_enr(t).where(F.trunc("transaction_date", "month") == F.lit(TOP5_MONTH))
    return (e.groupBy("merchant_id", "merchant_name").agg(completed_revenue().alias("revenue"))
             .orderBy(F.col("revenue").desc(), "merchant_id").limit(5))


@query("semantic_metric", f"""
SELECT e.category, e.payment_method, {REV_SQL} AS total_revenue, {FAIL_SQL} AS failure_rate_pct,
       COUNT(*) FILTER (WHERE status = 'COMPLETED') AS completed_transaction_count
FROM enr e WHERE e.quality_flag = 'CLEAN' GROUP BY 1, 2""")
def semantic_metric(t):
    """Registered metrics by any dimension set; asking for a merchant
    dimension adds the merchant join path (inner, as the relationship says)."""
    model = S.payments_model(t)
    return model.query(["total_revenue", "failure_rate_pct", "completed_transaction_count"],
                       ["category", "payment_method"])


@query("verified_query", f"""
SELECT merchant_name, category, COUNT(transaction_id) AS total_txns,
       COUNT(*) FILTER (WHERE status = 'COMPLETED') AS completed, {FAILED_SQL} AS failed,
       {FAIL_SQL} AS failure_rate_pct, {REV_SQL} AS revenue_usd
FROM enr WHERE quality_flag = 'CLEAN' GROUP BY merchant_name, category""")
def verified_query(t):
    """Run a stored, verified SQL query by name through ``spark.sql``."""
    model = S.payments_model(t)
    return model.verified("merchant_performance_summary")


@query("verified_revenue_by_merchant", f"""
SELECT merchant_name, {REV_SQL} AS revenue_usd FROM enr WHERE quality_flag = 'CLEAN' GROUP BY merchant_name""")
def verified_revenue_by_merchant(t):
    """The stored query for revenue by merchant."""
    return S.payments_model(t).verified("revenue_by_merchant")


@query("verified_failure_rate_by_method", f"""
SELECT payment_method, COUNT(*) AS total, {FAILED_SQL} AS failed, {FAIL_SQL} AS failure_rate_pct
FROM silver GROUP BY payment_method""")
def verified_failure_rate_by_method(t):
    """The stored query for the failure rate of each payment method."""
    return S.payments_model(t).verified("failure_rate_by_payment_method")


@query("mart_merchant_kpis", f"""
SELECT merchant_id, merchant_name, category, city, {REV_SQL} AS total_revenue, COUNT(*) AS total_transactions,
       {FAILED_SQL} AS failed_transactions, {FAIL_SQL} AS failure_rate_pct,
       {round_sql('AVG(amount)')} AS avg_transaction_value, COUNT(DISTINCT customer_id) AS unique_customers,
       MIN(transaction_date) AS first_transaction_date, MAX(transaction_date) AS last_transaction_date
FROM enr WHERE quality_flag = 'CLEAN' GROUP BY 1, 2, 3, 4""")
def mart_merchant_kpis(t):
    """Second mart form — all statuses, plus first/last transaction date."""
    return A.mart_merchant_kpis(clean_enr(t))

"""Aggregation operators (A1-A40) as DataFrame -> DataFrame functions.

Every aggregate here is a declarative ``groupBy().agg()``: Spark runs a
partial aggregate before the shuffle, so a hot key (one merchant holding a
third of all rows) arrives at the reducer as one partial row per map task.
Distinct counts go through Spark's distinct-aggregate rewrite, which first
de-duplicates on (key, value) — also skew-safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerlake.functions.scalars import (MONEY, completed_revenue, count_when,
                                          failure_pct, pct, round2)


def is_completed():
    return F.col("status") == "COMPLETED"


def is_failed():
    return F.col("status") == "FAILED"


def merchant_performance_total(enr: DataFrame) -> DataFrame:
    """Revenue, count and failure % per merchant (no date).

    Missing merchant attributes publish as empty strings (F5 ``or ""``).
    """
    return (enr.groupBy("merchant_id",
                        F.coalesce("merchant_name", F.lit("")).alias("merchant_name"),
                        F.coalesce("category", F.lit("")).alias("category"),
                        F.coalesce("city", F.lit("")).alias("city"))
               .agg(completed_revenue().alias("total_revenue"),
                    F.count(F.lit(1)).alias("txn_count"),
                    failure_pct().alias("failure_rate_pct")))


def merchant_performance(enr: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    """A11 (Gold 1): revenue, count, failure % per merchant and day."""
    return (enr.groupBy("merchant_id", "merchant_name", "category", "city",
                        F.col(date_col).alias("report_date"))
               .agg(completed_revenue().alias("total_revenue"),
                    F.count(F.lit(1)).alias("txn_count"),
                    failure_pct().alias("failure_rate_pct")))


def daily_summary(enr: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    """A14 (Gold 3): one row per day over all merchants."""
    return (enr.groupBy(F.col(date_col).alias("report_date"))
               .agg(completed_revenue().alias("total_revenue"),
                    F.count(F.lit(1)).alias("total_txns"),
                    F.count_distinct("customer_id").alias("unique_customers"),
                    F.count_distinct("merchant_id").alias("unique_merchants"),
                    failure_pct().alias("failure_rate_pct")))


def customer_ltv(enr: DataFrame) -> DataFrame:
    """A13 (Gold 2): lifetime value per customer over COMPLETED rows.

    ``preferred_payment_method`` is the most frequent method, ties to the
    lowest name (W2). ``mode(..., deterministic=True)`` keeps a small count
    map per customer and merges it partially before the shuffle, so the
    whole table is one aggregate — no second shuffle for a window.
    """
    done = enr.where(is_completed())
    return (done.groupBy("customer_id")
                .agg(F.sum(F.col("amount").cast(MONEY)).cast("double").alias("total_spent"),
                     F.count(F.lit(1)).alias("total_txns"),
                     round2(F.avg(F.col("amount").cast(MONEY))).alias("avg_txn_value"),
                     F.min("transaction_date").alias("first_txn_date"),
                     F.max("transaction_date").alias("last_txn_date"),
                     F.mode("payment_method", True).alias("preferred_payment_method")))


def preferred_method(enr: DataFrame, key: str = "customer_id", value: str = "payment_method") -> DataFrame:
    """W2 written as the reference does: counts, then the first row per key
    by (count desc, value asc). ``row_number() = 1`` becomes a
    WindowGroupLimit that also trims rows before the shuffle."""
    counts = enr.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy(key).orderBy(F.col("n").desc(), F.col(value).asc())
    return (counts.withColumn("rn", F.row_number().over(w)).where("rn = 1")
                  .select(key, F.col(value).alias("preferred_" + value), "n"))


def failure_rate_by(df: DataFrame, *keys: str) -> DataFrame:
    """Total, failed and failure % per key set."""
    return (df.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("total_txns"),
                   count_when(is_failed()).alias("failed_txns"),
                   failure_pct().alias("failure_rate_pct")))


def mart_merchant_performance(silver: DataFrame, merch: DataFrame) -> DataFrame:
    """The merchant mart — COMPLETED and FAILED rows aggregated per
    merchant first, then inner-joined to the merchant dimension, so the join
    sees one row per merchant instead of one per transaction."""
    f = silver.where(F.col("status").isin("COMPLETED", "FAILED"))
    agg = (f.groupBy("merchant_id")
            .agg(F.count("transaction_id").alias("total_transactions"),
                 count_when(is_completed()).alias("completed_transactions"),
                 count_when(is_failed()).alias("failed_transactions"),
                 completed_revenue().alias("total_revenue"),
                 round2(F.avg(F.when(is_completed(), F.col("amount").cast(MONEY)))).alias("avg_completed_value"),
                 F.count_distinct("customer_id").alias("unique_customers"),
                 failure_pct().alias("failure_rate_pct")))
    m = merch.select(F.col("merchant_id").alias("_mk"), "merchant_name", "category", "city")
    return agg.join(m, agg.merchant_id == m._mk, "inner").drop("_mk")


def suspicious_merchants(enr: DataFrame, min_txns: int, max_avg) -> DataFrame:
    """``HAVING count >= min_txns AND avg(amount) < max_avg``."""
    return (enr.groupBy("merchant_id")
               .agg(F.count(F.lit(1)).alias("txn_count"), F.avg("amount").alias("_avg"))
               .where((F.col("txn_count") >= min_txns) & (F.col("_avg") < max_avg))
               .select("merchant_id", "txn_count", round2("_avg").alias("avg_amount")))


def rfm(enr: DataFrame, anchor, churn_days: int) -> DataFrame:
    """Recency / frequency / monetary per customer with an at-risk flag."""
    rec = F.date_diff(F.lit(anchor), F.max("transaction_date"))
    return (enr.groupBy("customer_id")
               .agg(rec.alias("recency_days"), F.count(F.lit(1)).alias("frequency"),
                    completed_revenue().alias("monetary"))
               .withColumn("at_risk", F.col("recency_days") > churn_days))


def merchant_risk(enr: DataFrame, risk_rate) -> DataFrame:
    """Daily failure rate per merchant, suspicious flag, confidence by sample size."""
    n = F.col("txn_count")
    return (enr.groupBy("merchant_id", "transaction_date")
               .agg(F.count(F.lit(1)).alias("txn_count"),
                    count_when(is_failed()).alias("failed_count"),
                    failure_pct().alias("failure_rate_pct"))
               .withColumn("suspicious", F.col("failure_rate_pct") > risk_rate)
               .withColumn("confidence_level", F.when(n <= 1, "LOW").when(n <= 2, "MEDIUM")
                           .otherwise("HIGH")))


def customer_segments(enr: DataFrame, anchor, days: int, vip, high, mid) -> DataFrame:
    """Spend over the last ``days`` days before the anchor, tiered."""
    recent = enr.where((F.col("transaction_date") > F.date_sub(F.lit(anchor), days))
                       & (F.col("transaction_date") <= F.lit(anchor)))
    s = F.col("spend_30d")
    return (recent.groupBy("customer_id").agg(completed_revenue().alias("spend_30d"))
                  .withColumn("segment", F.when(s > vip, "VIP").when(s > high, "High")
                              .when(s >= mid, "Mid").otherwise("Low")))


def mart_merchant_kpis(enr: DataFrame) -> DataFrame:
    """Merchant KPIs over all statuses with first/last transaction date."""
    return (enr.groupBy("merchant_id", "merchant_name", "category", "city")
               .agg(completed_revenue().alias("total_revenue"),
                    F.count(F.lit(1)).alias("total_transactions"),
                    count_when(is_failed()).alias("failed_transactions"),
                    failure_pct().alias("failure_rate_pct"),
                    round2(F.avg("amount")).alias("avg_transaction_value"),
                    F.count_distinct("customer_id").alias("unique_customers"),
                    F.min("transaction_date").alias("first_transaction_date"),
                    F.max("transaction_date").alias("last_transaction_date")))


def avg_amount_by_merchant(df: DataFrame, positive_only: bool = True) -> DataFrame:
    """Count and mean amount per merchant (positive amounts only by default)."""
    if positive_only:
        df = df.where(F.col("amount") > 0)
    return df.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("n"), round2(F.avg("amount")).alias("avg_amount"))

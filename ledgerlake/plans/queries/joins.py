"""Registered join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.operators import aggregates as A
from ledgerlake.operators import joins as J
from ledgerlake.plans import frames as FR
from ledgerlake.plans.catalog import query
from ledgerlake.plans.oracle import round_sql
from ledgerlake.plans.queries.aggregates import DAILY_SQL, PERF_SQL, PROMO_SQL, _fee_sql_values

ANCHOR = FR.ANCHOR_DATE
INACTIVE_DAYS = 90                     # J11 window
PARTNER = 1                            # J16: partner id = merchant_id % 3

ENR_COLS = ("transaction_id, amount, status, merchant_id, customer_id, transaction_date, payment_method, "
            "merchant_name, category, city, quality_flag")
SPARK_ENR_COLS = [c.strip() for c in ENR_COLS.split(",")]


@query("enrich_broadcast_left", f"SELECT {ENR_COLS} FROM enr")
def enrich_broadcast_left(t):
    """Silver left-joined to the merchant dimension, broadcast after a size check."""
    return FR.enr_frame(t).select(*SPARK_ENR_COLS)


@query("enrich_map_lookup", f"SELECT {ENR_COLS} FROM enr")
def enrich_map_lookup(t):
    """The dict-lookup form — the same left join, planned by Catalyst/AQE
    without a hint; null attributes on a miss."""
    s = FR.silver_frame(t)
    m = FR.merch_frame(t).withColumnRenamed("merchant_id", "m_key")
    j = s.join(m, s.merchant_id == m.m_key, "left")
    return j.withColumn("quality_flag", F.when(F.col("m_key").isNull(), "UNMATCHED").otherwise("CLEAN")) \
            .select(*SPARK_ENR_COLS)


@query("inner_equi_join", """
SELECT s.transaction_id, s.merchant_id, m.merchant_name, m.category, s.amount
FROM silver s JOIN merch m ON s.merchant_id = m.merchant_id""")
def inner_equi_join(t):
    """Fact ⋈ merchant for names."""
    s = FR.silver_frame(t)
    m = FR.merch_frame(t).withColumnRenamed("merchant_id", "m_key")
    return s.join(m, s.merchant_id == m.m_key, "inner").select(
        "transaction_id", "merchant_id", "merchant_name", "category", "amount")


@query("implicit_comma_join", """
SELECT o.o_orderkey, c.c_name, CAST(o.o_totalprice AS DECIMAL(18,2)) AS amount
FROM orders o, customer c WHERE o.o_custkey = c.c_custkey""", frames=False)
def implicit_comma_join(t):
    """``FROM a, b WHERE a.k = b.k`` — Catalyst plans the same inner join."""
    t.orders.createOrReplaceTempView("orders")
    t.customer.createOrReplaceTempView("customer")
    return t.spark.sql("""SELECT o.o_orderkey, c.c_name, CAST(o.o_totalprice AS DECIMAL(18,2)) AS amount
                          FROM orders o, customer c WHERE o.o_custkey = c.c_custkey""")


@query("left_join_on_predicate", """
SELECT c.c_custkey AS customer_id, COUNT(o.transaction_id) AS completed_orders
FROM customer c LEFT JOIN ord o ON c.c_custkey = o.customer_id AND o.status = 'COMPLETED'
GROUP BY c.c_custkey""")
def left_join_on_predicate(t):
    """Every customer with its COMPLETED order count — zero included."""
    j = J.left_join_on_predicate(t.customer, FR.ord_frame(t))
    return j.groupBy(F.col("c_custkey").alias("customer_id")).agg(
        F.count("transaction_id").alias("completed_orders"))


@query("left_join_where_predicate", """
SELECT c.c_custkey AS customer_id, c.c_name AS customer_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM ord o WHERE o.customer_id = c.c_custkey AND o.status = 'COMPLETED')""")
def left_join_where_predicate(t):
    """The rows the buggy LEFT JOIN + WHERE form loses — customers without a
    COMPLETED order — found with ``left_anti`` against the buggy result."""
    c = t.customer
    buggy = J.left_join_where_predicate(c, FR.ord_frame(t)).select(F.col("c_custkey").alias("k")).distinct()
    return c.join(buggy, c.c_custkey == buggy.k, "left_anti").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))


@query("scalar_subquery_attr", """
SELECT o.o_orderkey AS transaction_id, c.c_name AS customer_name
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey""", frames=False)
def scalar_subquery_attr(t):
    """Correlated scalar lookup per row; Catalyst rewrites it into a left join."""
    t.orders.createOrReplaceTempView("orders")
    t.customer.createOrReplaceTempView("customer")
    return t.spark.sql("""SELECT o.o_orderkey AS transaction_id,
                                 (SELECT c.c_name FROM customer c WHERE c.c_custkey = o.o_custkey) AS customer_name
                          FROM orders o""")


@query("scalar_subquery_count", """
SELECT transaction_date, COUNT(*) FILTER (WHERE status = 'FAILED') AS failed_count, COUNT(*) AS total_count
FROM ord GROUP BY transaction_date""")
def scalar_subquery_count(t):
    """Correlated per-date count written as a subquery; Catalyst decorrelates
    it into an aggregate + join. (A9 is the hand-rewritten one-pass form.)"""
    FR.ord_frame(t).createOrReplaceTempView("ord")
    return t.spark.sql("""SELECT d.transaction_date,
                                 (SELECT COUNT(*) FROM ord f2
                                   WHERE f2.status = 'FAILED' AND f2.transaction_date = d.transaction_date) AS failed_count,
                                 d.total_count
                          FROM (SELECT transaction_date, COUNT(*) AS total_count FROM ord GROUP BY transaction_date) d""")


@query("three_way_join", f"""
SELECT gs.report_date, gs.total_revenue, gs.total_txns, e.transaction_id, gm.merchant_name,
       gm.total_revenue AS merchant_total
FROM {DAILY_SQL} gs JOIN enr e ON gs.report_date = e.transaction_date
JOIN {PERF_SQL} gm ON e.merchant_id = gm.merchant_id""")
def three_way_join(t):
    """Daily Gold ⋈ Silver ⋈ merchant Gold — every Silver row with its
    day's totals and its merchant's total. Enriched Silver feeds three
    branches, so it is materialised once in the shared folder."""
    from ledgerlake.session import materialize
    enr = materialize(FR.enr_frame(t), "enr")
    gs = A.daily_summary(enr)
    gm = A.merchant_performance_total(enr).select(
        F.col("merchant_id").alias("gm_id"), "merchant_name", F.col("total_revenue").alias("merchant_total"))
    e = enr.select("transaction_id", "transaction_date", F.col("merchant_id").alias("e_mid"))
    return (gs.join(e, gs.report_date == e.transaction_date)
              .join(gm, F.col("e_mid") == gm.gm_id)
              .select("report_date", "total_revenue", "total_txns", "transaction_id", "merchant_name",
                      "merchant_total"))


@query("fk_orphans_anti", """
SELECT merchant_id, COUNT(*) AS orphan_rows FROM silver s
WHERE NOT EXISTS (SELECT 1 FROM merch m WHERE m.merchant_id = s.merchant_id) GROUP BY merchant_id""")
def fk_orphans_anti(t):
    """Fact keys absent from the dimension (``left_anti``), with row counts."""
    return J.fk_orphans(FR.silver_frame(t), FR.merch_frame(t), "merchant_id") \
            .groupBy("merchant_id").agg(F.count(F.lit(1)).alias("orphan_rows"))


@query("dim_without_fact_anti", f"""
SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM ord o WHERE o.customer_id = c.c_custkey
                  AND o.transaction_date > DATE '{ANCHOR}' - INTERVAL {INACTIVE_DAYS} DAY
                  AND o.transaction_date <= DATE '{ANCHOR}')""")
def dim_without_fact_anti(t):
    """Customers with no order in the last 90 days before the anchor."""
    o = FR.ord_frame(t)
    recent = o.where((F.col("transaction_date") > F.date_sub(F.lit(ANCHOR), INACTIVE_DAYS))
                     & (F.col("transaction_date") <= F.lit(ANCHOR)))
    c = t.customer
    return c.join(recent, c.c_custkey == recent.customer_id, "left_anti").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))


@query("three_table_star", """
SELECT e.transaction_id, e.merchant_name, c.c_name AS customer_name, c.c_mktsegment AS tier, e.amount
FROM enr e JOIN customer c ON e.customer_id = c.c_custkey WHERE e.quality_flag = 'CLEAN'""")
def three_table_star(t):
    """Fact ⋈ merchant ⋈ customer."""
    e = FR.enr_frame(t).where(F.col("quality_flag") == "CLEAN")
    c = t.customer.select("c_custkey", F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("tier"))
    return e.join(c, e.customer_id == c.c_custkey).select(
        "transaction_id", "merchant_name", "customer_name", "tier", "amount")


@query("promo_attribution_join", f"""
SELECT e.transaction_id, e.customer_id, p.channel, e.amount,
       {round_sql('e.amount * p.discount_pct / 100')} AS discount_cost
FROM enr e JOIN {PROMO_SQL} p ON e.customer_id = p.customer_id""")
def promo_attribution_join(t):
    """Transactions of promoted customers with channel and discount cost."""
    from ledgerlake.functions.scalars import round2
    j = J.promo_attribution_join(FR.enr_frame(t), J.promotions(t.customer))
    return j.select("transaction_id", "customer_id", "channel", "amount", round2("discount_cost").alias("discount_cost"))


@query("fee_lookup_join", f"""
SELECT e.transaction_id, e.payment_method, e.amount, CAST(f.fee_rate AS DOUBLE) AS fee_rate,
       {round_sql('e.amount * (1 - f.fee_rate)')} AS effective_amount
FROM enr e JOIN {_fee_sql_values()} ON e.payment_method = f.payment_method""")
def fee_lookup_join(t):
    """Broadcast join of the literal fee table; effective = amount × (1 − rate)."""
    from ledgerlake.functions.scalars import round2
    j = J.fee_lookup_join(FR.enr_frame(t))
    return j.select("transaction_id", "payment_method", "amount", F.col("fee_rate").cast("double").alias("fee_rate"),
                    round2("effective_amount").alias("effective_amount"))


SETTLE_SQL = """(SELECT o_orderkey AS settle_key,
        CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 89 = 0 THEN 5 ELSE 0 END AS settled_amount,
        'GW' || CAST(o_orderkey % 3 AS VARCHAR) AS gateway
 FROM orders WHERE o_orderkey % 97 <> 0
 UNION ALL
 SELECT -o_orderkey - 1, CAST(o_totalprice AS DECIMAL(18,2)), 'GW' || CAST(o_orderkey % 3 AS VARCHAR)
 FROM orders WHERE o_orderkey % 101 = 0)"""


@query("reconcile_full_outer", f"""
WITH r AS (
  SELECT COALESCE(s.gateway, 'GW' || CAST(l.transaction_id % 3 AS VARCHAR)) AS gateway,
         CASE WHEN s.settle_key IS NULL THEN 'missing'
              WHEN l.transaction_id IS NULL THEN 'unexpected'
              WHEN ABS(s.settled_amount - l.amount) > 1 THEN 'disputed'
              ELSE 'matched' END AS recon_class,
         COALESCE(s.settled_amount, 0) - COALESCE(l.amount, 0) AS variance
  FROM ord l FULL OUTER JOIN {SETTLE_SQL} s ON l.transaction_id = s.settle_key)
SELECT gateway, recon_class, COUNT(*) AS n, CAST(SUM(variance) AS DOUBLE) AS net_variance
FROM r GROUP BY 1, 2""")
def reconcile_full_outer(t):
    """Ledger vs gateway settlement — matched / disputed (|diff| > 1) /
    missing (ledger only) / unexpected (gateway only); net variance per gateway."""
    return J.reconcile(FR.ord_frame(t), J.settlement(t.orders))


@query("semi_join_keys", f"""
SELECT transaction_id, merchant_id FROM enr e
WHERE e.merchant_id IN (SELECT merchant_id FROM merch WHERE merchant_id % 3 = {PARTNER})""")
def semi_join_keys(t):
    """Rows whose merchant belongs to the partner (``left_semi``)."""
    m = FR.merch_frame(t).where(F.col("merchant_id") % 3 == PARTNER).select(F.col("merchant_id").alias("k"))
    e = FR.enr_frame(t)
    return e.join(m, e.merchant_id == m.k, "left_semi").select("transaction_id", "merchant_id")


BUCKETS = 16


@query("bucketed_order_join", """
SELECT o_orderstatus, o_orderpriority, COUNT(*) AS items, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       COUNT(DISTINCT o_orderkey) AS orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""", frames=False)
def bucketed_order_join(t):
    """J3 co-located: line items and orders written once by buckets of the order key and joined without a shuffle."""
    from ledgerlake.session import scratch_path
    from ledgerlake.sources.bucketed import join_bucketed, write_bucketed
    items = write_bucketed(t.lineitem.select("l_orderkey", "l_extendedprice"), scratch_path(t.spark, "items_by_order"), "l_orderkey", BUCKETS)
    orders = write_bucketed(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), scratch_path(t.spark, "orders_by_key"), "o_orderkey", BUCKETS)
    joined = join_bucketed(items, orders, t.spark)
    return joined.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("items"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue"),
        F.count_distinct("l_orderkey").alias("orders"))

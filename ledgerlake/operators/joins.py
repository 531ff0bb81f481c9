"""Join operators.

Which side is broadcast is left to Spark: by file statistics when the plan is made, by real
shuffle sizes at run time (AQE), and both by a byte threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fee rate per payment method (the o_orderpriority names).
FEE_RATES = {
    "1-URGENT": 0.030,
    "2-HIGH": 0.025,
    "3-MEDIUM": 0.020,
    "4-NOT SPECIFIED": 0.015,
    "5-LOW": 0.010,
}


def left_join_on_predicate(customers: DataFrame, orders: DataFrame, status: str = "COMPLETED") -> DataFrame:
    """Keep every customer; the status test is part of the join condition,
    so customers without such orders survive with nulls."""
    cond = (customers.c_custkey == orders.customer_id) & (orders.status == status)
    return customers.join(orders, cond, "left")


def left_join_where_predicate(customers: DataFrame, orders: DataFrame, status: str = "COMPLETED") -> DataFrame:
    """The buggy form — the WHERE on the right side turns it into an inner join."""
    j = customers.join(orders, customers.c_custkey == orders.customer_id, "left")
    return j.where(F.col("status") == status)


def fee_lookup_join(df: DataFrame, rates: dict | None = None) -> DataFrame:
    """Join a literal fee table (a handful of rows: always broadcast) and
    compute ``effective_amount = amount * (1 - fee_rate)``."""
    spark = df.sparkSession
    rates = rates or FEE_RATES
    fees = spark.createDataFrame([(k, float(v)) for k, v in rates.items()],
                                 "fee_method string, fee_rate double")
    fees = fees.withColumn("fee_rate", F.col("fee_rate").cast("decimal(6,4)"))
    j = df.join(F.broadcast(fees), df.payment_method == fees.fee_method, "inner").drop("fee_method")
    return j.withColumn("effective_amount", F.col("amount") * (F.lit(1) - F.col("fee_rate")))


def promotions(customer: DataFrame) -> DataFrame:
    """The promotion fixture, derived from ``customer``: every third customer
    has a promotion; channel by key (Email / SMS / Push); discount 5-20 %."""
    k = F.col("c_custkey")
    chan = F.when((k % 9) / 3 < 1, "Email").when((k % 9) / 3 < 2, "SMS").otherwise("Push")
    return customer.where(k % 3 == 0).select(
        k.alias("promo_customer_id"), k.alias("promo_id"), chan.alias("channel"),
        (F.lit(5) * (F.lit(1) + k % 4)).cast("decimal(5,2)").alias("discount_pct"))


def promo_attribution_join(df: DataFrame, promos: DataFrame) -> DataFrame:
    """Transactions of promoted customers with their discount cost.

    ``promos`` grows with the customer table; Spark broadcasts it only below its byte threshold.
    """
    j = df.join(promos, df.customer_id == promos.promo_customer_id, "inner").drop("promo_customer_id")
    return j.withColumn("discount_cost", F.col("amount") * F.col("discount_pct") / 100)


def fk_orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """J10 / DQ6: fact rows whose key is absent from the dimension."""
    d = dim.select(F.col(dim_key or key).alias("_dk"))
    return fact.join(d, fact[key] == d["_dk"], "left_anti")


def settlement(orders: DataFrame) -> DataFrame:
    """The gateway settlement fixture derived from ``orders``: every 97th order
    is missing, every 89th is settled 5 higher, every 101st also appears under
    an unknown key; gateway by key."""
    k = F.col("o_orderkey")
    amt = F.col("o_totalprice").cast("decimal(18,2)")
    gw = F.concat(F.lit("GW"), (k % 3).cast("string"))
    base = orders.where(k % 97 != 0).select(
        k.alias("settle_key"), (amt + F.when(k % 89 == 0, F.lit(5)).otherwise(F.lit(0))).alias("settled_amount"),
        gw.alias("gateway"))
    extra = orders.where(k % 101 == 0).select((-k - 1).alias("settle_key"), amt.alias("settled_amount"),
                                               gw.alias("gateway"))
    return base.unionByName(extra)


def reconcile(ledger: DataFrame, settled: DataFrame, tolerance=1) -> DataFrame:
    """Full outer join on the key, class per pair, counts and net variance
    per gateway and class (a partial aggregate right after the join)."""
    j = ledger.join(settled, ledger.transaction_id == settled.settle_key, "full_outer")
    gw = F.coalesce(F.col("gateway"), F.concat(F.lit("GW"), (F.col("transaction_id") % 3).cast("string")))
    cls = (F.when(F.col("settle_key").isNull(), "missing")
            .when(F.col("transaction_id").isNull(), "unexpected")
            .when(F.abs(F.col("settled_amount") - F.col("amount")) > tolerance, "disputed")
            .otherwise("matched"))
    var = F.coalesce(F.col("settled_amount"), F.lit(0)) - F.coalesce(F.col("amount"), F.lit(0))
    return (j.select(gw.alias("gateway"), cls.alias("recon_class"), var.alias("variance"))
             .groupBy("gateway", "recon_class")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("variance").cast("double").alias("net_variance")))

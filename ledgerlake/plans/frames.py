"""The payments star schema, derived from the driver's TPC-H-like tables.

``orders`` becomes the transaction header (ORD), ``lineitem ⋈ orders`` the
raw transaction feed (BRONZE), ``supplier ⋈ nation ⋈ region`` the merchant
dimension (MERCH), BRONZE cleaned and de-duplicated is SILVER, and SILVER
left-joined to MERCH with a quality flag is ENR — the usual operator input.

Dirty rows are injected by deterministic integer rules so any engine given
the same tables produces the same frames.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerlake.sources.tables import Tables

# Fixed values of the domain: status codes and the reporting anchor date.
STATUS_MAP = {"O": "COMPLETED", "F": "FAILED"}  # anything else -> PENDING
ANCHOR_DATE = dt.date(2001, 8, 1)
FUTURE_DATE = dt.date(2099, 12, 31)
MONEY = "decimal(18,2)"

# Order of the dedup pick: latest ingestion first, then a total tie-break.
def dedup_order():
    return [F.col("ingestion_ts").desc(), F.col("tie1"), F.col("merchant_id"), F.col("amount"),
            F.col("tie2"), F.col("tie3"), F.col("tie4"), F.col("return_flag")]


def status_of(code: Column) -> Column:
    return (F.when(code == "O", F.lit(STATUS_MAP["O"]))
            .when(code == "F", F.lit(STATUS_MAP["F"]))
            .otherwise(F.lit("PENDING")))


def status_code_predicate(statuses) -> Column:
    """The raw-code predicate equal to ``status IN statuses`` (pushable to Parquet)."""
    code = F.col("o_orderstatus")
    inverse = {v: k for k, v in STATUS_MAP.items()}
    known = [inverse[s] for s in statuses if s in inverse]
    pred = code.isin(*known) if known else F.lit(False)
    if "PENDING" in statuses:
        pred = pred | code.isNull() | ~code.isin(*STATUS_MAP)
    return pred


def ord_frame(t: Tables, statuses=None, after=None, until=None) -> DataFrame:
    """ORD: one row per order with payment names.

    ``statuses`` / ``after`` / ``until`` filter on the raw columns *before*
    decoding, so Parquet gets ``PushedFilters`` on the order status code and
    the order timestamp (a date ``d > after`` is ``o_orderdate >= after + 1 day``).
    """
    o = t.orders
    if statuses is not None:
        o = o.where(status_code_predicate(statuses))
    if after is not None:
        o = o.where(F.col("o_orderdate") >= F.lit(dt.datetime.combine(after + dt.timedelta(days=1), dt.time()))
                    .cast("timestamp_ntz"))
    if until is not None:
        o = o.where(F.col("o_orderdate") < F.lit(dt.datetime.combine(until + dt.timedelta(days=1), dt.time()))
                    .cast("timestamp_ntz"))
    return o.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        status_of(F.col("o_orderstatus")).alias("status"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.col("o_orderpriority").alias("payment_method"),
    )


def item_columns() -> list[Column]:
    """The columns of BRONZE that line items alone decide, dirt included, with the order key and line."""
    pk = F.col("l_partkey")
    price = F.col("l_extendedprice").cast(MONEY)
    return [
        F.col("l_orderkey").alias("item_order"), F.col("l_linenumber").alias("item_line"),
        F.when(pk % 50 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                             F.col("l_linenumber").cast("string"))).alias("transaction_id"),
        F.when(pk % 53 == 1, -price)
         .when(pk % 59 == 2, F.lit(0).cast(MONEY))
         .otherwise(price).alias("amount"),
        F.col("l_suppkey").alias("merchant_id"),
        F.when(pk % 61 == 3, F.lit(FUTURE_DATE))
         .otherwise(F.col("l_shipdate").cast("date")).alias("transaction_date"),
        F.col("l_shipdate").alias("ingestion_ts"),
        pk.alias("tie1"),
        F.col("l_quantity").alias("tie2"),
        F.col("l_discount").alias("tie3"),
        F.col("l_tax").alias("tie4"),
        F.col("l_returnflag").alias("return_flag"),
    ]


def item_frame(t: Tables) -> DataFrame:
    """Line items as :func:`item_columns`."""
    return t.lineitem.select(*item_columns())


BRONZE_COLUMNS = ["transaction_id", "amount", "status", "merchant_id", "customer_id", "transaction_date", "payment_method",
                  "ingestion_ts", "tie1", "tie2", "tie3", "tie4", "return_flag"]


def with_order(items: DataFrame, t: Tables) -> DataFrame:
    """Items with their order's status, customer and payment method, in BRONZE's columns.

    The one big join of the model (lineitem ⋈ orders on the order key); at
    scale both tables should be bucketed or partitioned on the order key so
    the join is co-located.
    """
    return _decoded(items.join(_order_columns(t), F.col("item_order") == F.col("o_key"), "inner"))


def _order_columns(t: Tables) -> DataFrame:
    return ord_frame(t).select(F.col("transaction_id").alias("o_key"), "status", "customer_id", "payment_method")


def _decoded(joined: DataFrame) -> DataFrame:
    status = F.when(F.col("tie1") % 67 == 4, F.lit("APPROVED")).otherwise(F.col("status"))
    return joined.withColumn("status", status).select(*BRONZE_COLUMNS)


def bronze_frame(t: Tables) -> DataFrame:
    """BRONZE: every line item as a raw transaction, dirt included. The join moves the table's own columns, and what
    is made of them (ids as text, decimals) is made behind it."""
    joined = t.lineitem.join(_order_columns(t), F.col("l_orderkey") == F.col("o_key"), "inner")
    return _decoded(joined.select(*item_columns(), "status", "customer_id", "payment_method"))


def merch_frame(t: Tables) -> DataFrame:
    """MERCH: suppliers with non-negative balance, named by nation and region."""
    s = t.supplier.where(F.col("s_acctbal") >= 0)
    n = t.nation
    r = t.region
    return (s.join(n, s.s_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("s_suppkey").alias("merchant_id"),
                     F.col("s_name").alias("merchant_name"),
                     F.col("n_name").alias("category"),
                     F.col("r_name").alias("city")))


def silver_rules(bronze: DataFrame) -> DataFrame:
    """Id present and amount not negative."""
    return bronze.where(F.col("transaction_id").isNotNull() & (F.col("amount") >= 0))


def dedup_latest(df: DataFrame, key: str | list[str] = "transaction_id", order=None) -> DataFrame:
    """One row per key, the first by a total order.

    ``row_number() == 1`` is planned as a WindowGroupLimit that also runs
    *before* the shuffle, so a hot key is cut to one row per map task.
    """
    order = order or dedup_order()
    w = W.partitionBy(key).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1)


def silver_frame(t: Tables) -> DataFrame:
    """Silver straight from the tables: rules and dedup on the line items, then the order join.

    All repeats of a transaction share its order, and the dedup order is made of item columns, so the
    rows are those of ``dedup_latest(silver_rules(bronze_frame(t)))``; but the join meets only the
    rows that stay. The window is dealt by order and line, not by order alone as the join is: that would save
    a shuffle, but one hot order would then sit in a single task through both, and AQE could not split the join.
    """
    one = dedup_latest(silver_rules(item_frame(t)), ["item_order", "item_line"])
    return with_order(one, t).withColumn("rn", F.lit(1))


def enrich(silver: DataFrame, merch: DataFrame) -> DataFrame:
    """J1 + P10: left join the merchant dimension and flag misses.

    The flag tests the right side's own key (``m_key``), never the USING key,
    which would take the left value and never be null.
    """
    m = merch.withColumnRenamed("merchant_id", "m_key")
    return (silver.join(m, silver.merchant_id == m.m_key, "left")
                  .withColumn("quality_flag",
                              F.when(F.col("m_key").isNull(), F.lit("UNMATCHED"))
                               .otherwise(F.lit("CLEAN")))
                  .drop("m_key"))


def enr_frame(t: Tables) -> DataFrame:
    return enrich(silver_frame(t), merch_frame(t))

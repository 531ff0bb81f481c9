"""Projection and filter operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compliance_flag(df: DataFrame, threshold) -> DataFrame:
    """``requires_review`` when the amount exceeds the threshold."""
    return df.withColumn("requires_review", F.col("amount") > F.lit(threshold))


# Fixed values of the SQL guard (P14): forbidden statement keywords in the
# order they are tested, and the tables a query must reference.
FORBIDDEN_KEYWORDS = ["DROP", "DELETE", "INSERT", "UPDATE", "TRUNCATE", "ALTER", "CREATE"]
KNOWN_TABLES = ["FACT_TRANSACTIONS", "DIM_MERCHANT"]

_WS_TRIM = r"^\s+|\s+$"


def strip_ws(c):
    """Python ``str.strip()``: all leading/trailing whitespace, not only spaces."""
    return F.regexp_replace(c, _WS_TRIM, "")


def sql_text_extract(df: DataFrame, text_col: str = "text", out: str = "sql") -> DataFrame:
    """SQL out of model output — a ```sql fence, else a bare fence
    holding a SELECT, else the whole text if it starts with SELECT, else null.
    Runs on the whole text with built-in regex functions; the stripped text
    is computed once."""
    t = F.col(text_col)
    # The two fence patterns.
    fenced = F.nullif(F.regexp_extract(t, r"(?s)```sql\s*(.*?)\s*```", 1), F.lit(""))
    bare = F.nullif(F.regexp_extract(t, r"(?is)```\s*(SELECT.*?)\s*```", 1), F.lit(""))
    st = F.col("_stripped")
    plain = F.when(F.upper(st).startswith("SELECT"), st)
    return (df.withColumn("_stripped", strip_ws(t))
              .withColumn(out, F.coalesce(strip_ws(fenced), strip_ws(bare), plain))
              .drop("_stripped"))


def sql_text_guard(df: DataFrame, sql_col: str = "sql") -> DataFrame:
    """Classify query texts: empty / not a SELECT / forbidden keyword
    (word-bounded, first in list order) / no known table / valid.

    One ordered ``CASE`` of built-in regex tests over the upper-cased text
    (computed once) — a projection, no shuffle.
    """
    s = F.col(sql_col)
    up = F.col("_up")
    reason = F.when(s.isNull() | (F.length(s) == 0), F.lit("empty"))
    reason = reason.when(~up.startswith("SELECT"), F.lit("not_select"))
    for kw in FORBIDDEN_KEYWORDS:
        reason = reason.when(up.rlike(rf"(^|[^A-Z0-9_]){kw}([^A-Z0-9_]|$)"), F.lit(f"forbidden:{kw}"))
    known = None
    for tname in KNOWN_TABLES:
        hit = F.contains(up, F.lit(tname))
        known = hit if known is None else (known | hit)
    reason = reason.when(~known, F.lit("no_known_table")).otherwise(F.lit("ok"))
    return (df.withColumn("_up", F.upper(strip_ws(s))).withColumn("reason", reason).drop("_up")
              .withColumn("is_valid", F.col("reason") == "ok"))


def query_log(orders: DataFrame, conversations: DataFrame) -> DataFrame:
    """A query log derived from the tables: one model-style answer per order
    (its form chosen by the order key) plus every conversation turn's text."""
    k = F.col("o_orderkey")
    ks, cs = k.cast("string"), F.col("o_custkey").cast("string")
    form = k % 6
    text = (F.when(k % 11 == 0, F.lit(""))
            .when(form == 0, F.concat(F.lit("```sql\nSELECT COUNT(*) FROM FACT_TRANSACTIONS WHERE CUSTOMER_ID = "),
                                      cs, F.lit("\n```")))
            .when(form == 1, F.concat(F.lit("Here you go: ```\nselect * from DIM_MERCHANT where merchant_id = "),
                                      cs, F.lit("\n``` done")))
            .when(form == 2, F.concat(F.lit("SELECT "), ks, F.lit("; DROP TABLE FACT_TRANSACTIONS")))
            .when(form == 3, F.concat(F.lit("```sql\nDELETE FROM FACT_TRANSACTIONS WHERE TRANSACTION_ID = "), ks,
                                      F.lit("\n```")))
            .when(form == 4, F.concat(F.lit("SELECT * FROM ORDERS_"), F.col("o_orderpriority"),
                                      F.lit(" WHERE ID = "), ks))
            .otherwise(F.concat(F.lit("  select amount from fact_transactions where status = 'DROPPED' and id = "),
                                ks, F.lit("\n"))))
    a = orders.select(F.lit("orders").alias("source"), k.alias("entry_id"), F.lit(0).cast("bigint").alias("turn"),
                      text.alias("text"))
    b = conversations.select(F.lit("conversations").alias("source"), F.col("conv_id").alias("entry_id"),
                             F.col("turn"), F.col("text"))
    return a.unionByName(b)


def exclude_prefix(df: DataFrame, col_name: str, prefix: str) -> DataFrame:
    """Drop rows whose value starts with the literal prefix (nulls kept)."""
    c = F.col(col_name)
    return df.where(c.isNull() | ~F.startswith(c, F.lit(prefix)))


def after_cutoff(df: DataFrame, col_name: str, cutoff) -> DataFrame:
    """Strictly after the cutoff (X15: ``>``, not ``>=``)."""
    return df.where(F.col(col_name) > F.lit(cutoff))


def year_to_date(df: DataFrame, col_name: str, anchor) -> DataFrame:
    """Rows from the anchor's year start to the anchor, with their month window."""
    c = F.col(col_name)
    return (df.where(c.between(F.trunc(F.lit(anchor), "year"), F.lit(anchor)))
              .withColumn("month", F.trunc(c, "month")))

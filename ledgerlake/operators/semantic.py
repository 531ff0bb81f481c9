"""A small semantic layer — named metrics, dimensions with their
join path, and verified named SQL queries.

Metrics are plain ``Column`` aggregate expressions and dimensions are
columns of the fact or of a related dimension table; ``query`` adds a join
only when a requested dimension needs it, then runs one ``groupBy().agg()``.
Verified queries are stored SQL text run through ``spark.sql`` over temp
views of the same frames, so Catalyst plans them like any other query.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import completed_revenue, count_when, failure_pct


@dataclass
class Relationship:
    name: str
    table: Callable[[], DataFrame]
    left_key: str
    right_key: str
    columns: tuple[str, ...]
    how: str = "inner"


@dataclass
class SemanticModel:
    fact: Callable[[], DataFrame]
    metrics: dict[str, Callable[[], Column]]
    relationships: list[Relationship] = field(default_factory=list)
    verified_queries: dict[str, str] = field(default_factory=dict)
    views: dict[str, Callable[[], DataFrame]] = field(default_factory=dict)

    def query(self, metrics: list[str], dims: list[str]) -> DataFrame:
        df = self.fact()
        for rel in self.relationships:
            needed = [d for d in dims if d in rel.columns and d not in df.columns]
            if needed:
                right = rel.table().select(F.col(rel.right_key).alias("_rk"), *needed)
                df = df.join(right, df[rel.left_key] == right["_rk"], rel.how).drop("_rk")
        missing = [m for m in metrics if m not in self.metrics]
        if missing:
            raise KeyError(f"unknown metrics {missing}")
        return df.groupBy(*dims).agg(*[self.metrics[m]().alias(m) for m in metrics])

    def verified(self, name: str) -> DataFrame:
        sql = self.verified_queries[name]
        spark = self.fact().sparkSession
        for v, build in self.views.items():
            build().createOrReplaceTempView(v)
        return spark.sql(sql)


# Metric expressions of the payments model.
PAYMENT_METRICS: dict[str, Callable[[], Column]] = {
    "total_revenue": completed_revenue,
    "failure_rate_pct": failure_pct,
    "completed_transaction_count": lambda: count_when(F.col("status") == "COMPLETED"),
    "total_transactions": lambda: F.count(F.lit(1)),
    "unique_customers": lambda: F.count_distinct("customer_id"),
}

# Verified queries over the views ``fact_transactions`` and ``dim_merchant``. Names and result columns are
# fixed values; transactions are summed per merchant before they meet the dimension.
PER_MERCHANT = """
    SELECT merchant_id, count(*) AS n, count(*) FILTER (WHERE status = 'COMPLETED') AS good,
           count(*) FILTER (WHERE status = 'FAILED') AS bad, sum(amount) FILTER (WHERE status = 'COMPLETED') AS paid
    FROM fact_transactions GROUP BY merchant_id"""
RATE = "CAST(round(try_divide(100 * CAST({bad} AS DECIMAL(20,0)), CAST({n} AS DECIMAL(20,0))), 2) AS DOUBLE)"
VERIFIED_QUERIES = {
    "total_transaction_count": "SELECT count(*) AS total_transactions FROM fact_transactions",
    "failed_transaction_count": "SELECT count(*) FILTER (WHERE status = 'FAILED') AS failed_count FROM fact_transactions",
    "revenue_by_merchant": f"""
        SELECT merchant_name, CAST(coalesce(sum(paid), 0) AS DOUBLE) AS revenue_usd
        FROM ({PER_MERCHANT}) JOIN dim_merchant USING (merchant_id) GROUP BY merchant_name""",
    "failure_rate_by_payment_method": f"""
        SELECT payment_method, n AS total, bad AS failed, {RATE.format(bad='bad', n='n')} AS failure_rate_pct
        FROM (SELECT payment_method, count(*) AS n, count(*) FILTER (WHERE status = 'FAILED') AS bad
              FROM fact_transactions GROUP BY payment_method)""",
    "merchant_performance_summary": f"""
        SELECT merchant_name, category, sum(n) AS total_txns, sum(good) AS completed, sum(bad) AS failed,
               {RATE.format(bad='sum(bad)', n='sum(n)')} AS failure_rate_pct,
               CAST(coalesce(sum(paid), 0) AS DOUBLE) AS revenue_usd
        FROM ({PER_MERCHANT}) JOIN dim_merchant USING (merchant_id) GROUP BY merchant_name, category""",
}


def payments_model(t) -> SemanticModel:
    """The model over the driver tables: fact = Silver, merchant relationship
    = MERCH (many-to-one, inner as the relationship declares)."""
    from ledgerlake.plans import frames as FR

    return SemanticModel(
        fact=lambda: FR.silver_frame(t),
        metrics=PAYMENT_METRICS,
        relationships=[Relationship("transactions_to_merchant", lambda: FR.merch_frame(t),
                                    "merchant_id", "merchant_id",
                                    ("merchant_name", "category", "city"))],
        verified_queries=VERIFIED_QUERIES,
        views={"fact_transactions": lambda: FR.silver_frame(t),
               "dim_merchant": lambda: FR.merch_frame(t)},
    )

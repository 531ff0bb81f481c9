"""Window operators.

Per-key windows over the raw fact are avoided where a hot key would land in
one task: W3 is an aggregate joined back (partial aggregation + AQE skew
join), W1/W4/W2 rely on ``row_number() = 1`` being planned as a
WindowGroupLimit that trims each key before the shuffle. Windows without a
partition key (W5, W6) only ever run on already-aggregated frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerlake.functions.scalars import MONEY, round2


def first_per_key(df: DataFrame, key, order) -> DataFrame:
    """One row per key: the first under a total ``order`` (W1 desc, W4 asc)."""
    keys = [key] if isinstance(key, str) else list(key)
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def partition_total(df: DataFrame, key: str, value: str, cond=None, out: str = "partition_total") -> DataFrame:
    """``SUM(value) OVER (PARTITION BY key)`` on every row.

    Written as aggregate + join back: the aggregate is combined map-side, and
    AQE broadcasts the per-key totals when their runtime size is small, else
    keeps a shuffle join and splits a hot key's partition.
    """
    v = F.col(value).cast(MONEY)
    if cond is not None:
        v = F.when(cond, v)
    # derived side: AQE broadcasts it when its runtime size is small, else
    # keeps the shuffle join and splits a hot key's partition
    totals = df.groupBy(F.col(key).alias("_k")).agg(F.sum(v).alias(out))
    return df.join(totals, df[key].eqNullSafe(totals["_k"]), "left").drop("_k")


def surge_vs_other_days(daily: DataFrame, date_col: str = "report_date", value: str = "total_revenue") -> DataFrame:
    """Each day's value against the mean of all *other* days:
    ``(sum − self) / (n − 1)``, with the surge in % and the number of days.
    The daily table, a row per day, is written once; total and day count are aggregates of it (scalar subqueries)."""
    from ledgerlake.session import materialize
    daily = materialize(daily.select(date_col, value), "daily")
    tot = daily.agg(F.sum(value).alias("s"), F.count(F.lit(1)).alias("n"))
    s_all, n = tot.select("s").scalar(), tot.select("n").scalar()
    others = F.try_divide(s_all - F.col(value), n - 1)
    return daily.select(date_col, value, n.alias("n_days"),
                        round2(others).alias("mean_other_days"),
                        round2(F.try_divide((F.col(value) - others) * 100, others)).alias("surge_pct"))


def rank_by(df: DataFrame, value: str, out: str = "revenue_rank") -> DataFrame:
    """Exact ``rank() OVER (ORDER BY value DESC)`` without a key-less window.

    rank = 1 + number of rows with a greater value. Distinct values (with their multiplicity) are dealt by
    range, nulls last; a value's partition is its bucket. Per-bucket totals give each bucket's offset (a window
    over one row per shuffle partition), and the rows above a value inside its bucket come from a window
    *partitioned by bucket*. Ranks join back to the rows on the value. The rows are computed once.
    """
    from ledgerlake.session import materialize
    df = materialize(df, "rank_rows")
    v = df.groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    v = materialize(v.repartitionByRange(F.col("_v").desc_nulls_last()).withColumn("_bk", F.spark_partition_id()), "rank_values")
    per_bucket = v.groupBy("_bk").agg(F.sum("_c").alias("_bc"))
    above = W.orderBy("_bk").rowsBetween(W.unboundedPreceding, -1)     # a row per shuffle partition
    offs = F.broadcast(per_bucket.select("_bk", F.coalesce(F.sum("_bc").over(above), F.lit(0)).alias("_off")))
    inside = W.partitionBy("_bk").orderBy(F.col("_v").desc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    ranks = (v.join(offs, "_bk")
              .select("_v", (F.lit(1) + F.col("_off") + F.coalesce(F.sum("_c").over(inside), F.lit(0)))
                      .cast("int").alias(out)))
    return df.join(ranks, df[value].eqNullSafe(ranks["_v"]), "left").drop("_v")

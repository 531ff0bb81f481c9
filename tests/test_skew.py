"""Hot keys: a third of all rows on one transaction id and one merchant.

The skewed frame is derived from the driver's Bronze table; Spark's results
are checked against a brute-force pandas computation of the same semantics.
"""

import contextlib
import io
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import aggregates as A
from ledgerlake.plans import frames as FR
from ledgerlake.sources.tables import Tables

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def skewed(spark):
    b = FR.bronze_frame(Tables(spark, SF_SMALL))
    hot = F.col("tie1") % 3 == 0
    return (b.withColumn("transaction_id", F.when(hot & F.col("transaction_id").isNotNull(), F.lit("HOT-1"))
                         .otherwise(F.col("transaction_id")))
             .withColumn("merchant_id", F.when(hot, F.lit(1).cast("bigint")).otherwise(F.col("merchant_id")))
             .cache())


def test_dedup_under_a_hot_id(skewed):
    got = FR.dedup_latest(FR.silver_rules(skewed)).drop("rn").toPandas()
    pdf = skewed.toPandas()
    pdf = pdf[pdf.transaction_id.notna() & (pdf.amount >= 0)]
    pdf = pdf.sort_values(["ingestion_ts", "tie1", "merchant_id", "amount", "tie2", "tie3", "tie4", "return_flag"],
                          ascending=[False, True, True, True, True, True, True, True])
    want = pdf.drop_duplicates("transaction_id", keep="first")
    assert len(got) == len(want) == pdf.transaction_id.nunique()
    hot_got = got[got.transaction_id == "HOT-1"].iloc[0]
    hot_want = want[want.transaction_id == "HOT-1"].iloc[0]
    assert (hot_got.tie1, hot_got.amount) == (hot_want.tie1, hot_want.amount)


def test_merchant_totals_under_a_hot_merchant(skewed):
    got = {r.merchant_id: r for r in A.failure_rate_by(skewed, "merchant_id").collect()}
    pdf = skewed.toPandas()
    for mid, g in pdf.groupby("merchant_id"):
        n, f = len(g), int((g.status == "FAILED").sum())
        rate = float((Decimal(100) * f / Decimal(n)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
        assert (got[mid].total_txns, got[mid].failed_txns, got[mid].failure_rate_pct) == (n, f, rate)
    assert got[1].total_txns >= len(pdf) // 3


def test_hot_keys_are_combined_before_the_shuffle(skewed):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        A.failure_rate_by(skewed, "merchant_id").explain()
        FR.dedup_latest(FR.silver_rules(skewed)).explain()
    plan = buf.getvalue()
    assert "HashAggregate(keys=[merchant_id" in plan and "partial_count" in plan
    assert plan.count("WindowGroupLimit") >= 2


def test_distributed_rank_matches_brute_force_with_ties(spark):
    from ledgerlake.operators.windows import rank_by
    b = FR.bronze_frame(Tables(spark, SF_SMALL))
    daily = b.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("n"))
    got = rank_by(daily, "n", "r").toPandas().sort_values("transaction_date").reset_index(drop=True)
    want = daily.toPandas().sort_values("transaction_date").reset_index(drop=True)
    want["r"] = want["n"].rank(method="min", ascending=False).astype(int)
    assert got["n"].nunique() < len(got)            # ties present
    assert (got["r"].values == want["r"].values).all()

"""Property tests of the exact rate helper against Python decimals and the oracle form."""

from decimal import ROUND_HALF_UP, Decimal

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import pct
from ledgerlake.plans.oracle import pct_sql

pairs = st.lists(st.tuples(st.integers(0, 10**7), st.integers(1, 10**7)).map(lambda p: (min(p), p[1])),
                 min_size=50, max_size=200)


def exact(n, d):
    return float((Decimal(100) * n / Decimal(d)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


@settings(max_examples=5, deadline=None)
@given(pairs)
def test_pct_is_exact_half_up(spark, rows):
    df = spark.createDataFrame(rows, "n long, d long").select("n", "d", pct(F.col("n"), F.col("d")).alias("p"))
    for r in df.collect():
        assert r.p == exact(r.n, r.d)


@settings(max_examples=5, deadline=None)
@given(pairs)
def test_oracle_rate_agrees(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE x (n BIGINT, d BIGINT)")
    con.executemany("INSERT INTO x VALUES (?, ?)", rows)
    for n, d, p in con.execute(f"SELECT n, d, {pct_sql('n', 'd')} FROM x").fetchall():
        assert p == exact(n, d)


def test_rate_of_zero_denominator_is_null(spark):
    assert spark.range(1).select(pct(F.lit(1), F.lit(0)).alias("p")).first().p is None

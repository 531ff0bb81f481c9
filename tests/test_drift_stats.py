"""KS and renames from sketches, against brute force on all values."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import drift as SD
from ledgerlake.operators import drift_stats as D


def _ks(rows):
    a, b = ([x for r, x in rows if r == side and x is not None] for side in (True, False))
    return max(abs(sum(v <= x for v in a) / len(a) - sum(v <= x for v in b) / len(b)) for x in {*a, *b})


@pytest.mark.parametrize("seed, shift, digits", [(1, 0, 2), (2, 3, 2), (3, 40, 2), (4, 1, 0)])
def test_ks_is_exact_and_sorts_few_rows(spark, seed, shift, digits):
    r = random.Random(seed)
    rows = [(i % 2 == 0, None if i % 97 == 0 else Decimal(str(round(r.gauss(100 + (i % 2) * shift, 20), digits)))) for i in range(4000)]
    got = D.distribution_drift(spark.createDataFrame(rows, "ref boolean, x decimal(18,2)"), "ref", [], {"x": 10.0}).first()
    assert got["ks"] == pytest.approx(_ks(rows), abs=1e-6)
    assert got["refined_share"] < 0.35


@pytest.mark.parametrize("rows", [
    [(True, 1), (False, 1)], [(True, 1), (False, 2)], [(True, 5)] * 50 + [(False, 5)] * 9 + [(False, 6)], [(True, 1), (True, 3), (False, 2), (False, 2)]])
def test_ks_of_few_values(spark, rows):
    rows = [(r, Decimal(x)) for r, x in rows]
    got = D.distribution_drift(spark.createDataFrame(rows, "ref boolean, x decimal(18,2)"), "ref", [], {"x": 1.0}).first()
    assert got["ks"] == pytest.approx(_ks(rows), abs=1e-6)


def test_ks_without_a_side_or_rows(spark):
    for rows in ([(True, Decimal(1))], [(True, None), (False, None)]):
        got = D.distribution_drift(spark.createDataFrame(rows, "ref boolean, x decimal(18,2)"), "ref", [], {"x": 1.0}).first()
        assert got["ks"] is None


def test_buckets_by_binary_search(spark):
    edges = [Decimal(x) for x in (1, 2, 5, 9, 11)]
    got = spark.range(13).select(D.bucket_of(F.col("id").cast("decimal(18,2)"), edges).alias("b")).collect()
    assert [x["b"] for x in got] == [sum(e < i for e in edges) for i in range(13)]


def test_renames_from_sketches(spark):
    n = 3000
    before = spark.range(n).select(F.col("id").alias("kept"), (F.col("id") * 7).alias("old"), (F.col("id") % 50).alias("gone"), F.lit("x").alias("word"))
    after = spark.range(n).select(F.col("id").alias("kept"), ((F.col("id") + 300) * 7).alias("new"), (F.col("id") + 10**6).alias("fresh"))
    got = {(r["column_name"], r["change"]): r["proposed_rename"] for r in SD.version_diff({"a": before, "b": after}, 0.5).collect()}
    assert got == {("old", "removed"): "old -> new", ("new", "added"): "old -> new", ("gone", "removed"): None, ("word", "removed"): None, ("fresh", "added"): None}
    # Just below and just above the threshold the exact count decides: 0.8182 of the values are shared.
    assert any(r["proposed_rename"] for r in SD.version_diff({"a": before, "b": after}, 0.818).collect())
    assert not any(r["proposed_rename"] for r in SD.version_diff({"a": before, "b": after}, 0.819).collect())
    assert SD.version_diff({"a": before, "b": before}, 0.5).collect() == []

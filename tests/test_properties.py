"""Property tests: distributed operators against brute force on random inputs."""

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.operators.windows import first_per_key, rank_by
from ledgerlake.session import sql_conf

values = st.lists(st.one_of(st.integers(-50, 50), st.none()), min_size=1, max_size=60)


@settings(max_examples=6, deadline=None)
@given(values, st.integers(1, 9))
def test_rank_by_equals_sql_rank(spark, vals, partitions):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v int")
    with sql_conf(spark, spark__sql__shuffle__partitions=partitions, spark__sql__adaptive__coalescePartitions__enabled="false"):
        got = rank_by(df, "v", "r").toPandas().sort_values("id")
    want = pd.Series(vals, dtype="float").rank(method="min", ascending=False, na_option="bottom").astype(int).tolist()
    assert got["r"].tolist() == want


rows = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 100)), min_size=1, max_size=60)


@settings(max_examples=6, deadline=None)
@given(rows)
def test_first_per_key_is_the_minimum_by_total_order(spark, rs):
    df = spark.createDataFrame([(k, a, b, i) for i, (k, a, b) in enumerate(rs)], "k int, a int, b int, i int")
    got = first_per_key(df, "k", [F.col("a").desc(), F.col("b"), F.col("i")]).toPandas()
    pdf = pd.DataFrame(rs, columns=["k", "a", "b"]).assign(i=range(len(rs)))
    want = pdf.sort_values(["a", "b", "i"], ascending=[False, True, True]).drop_duplicates("k")
    assert sorted(got["i"].tolist()) == sorted(want["i"].tolist())

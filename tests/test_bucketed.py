"""Tables by buckets of the join key: joined without a shuffle, frequent keys apart, against an ordinary join."""

import contextlib
import io
import random

import pytest

from ledgerlake.session import scratch_path, sql_conf
from ledgerlake.sources.bucketed import Bucketed, join_bucketed, write_bucketed


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def _sides(spark, hot):
    r = random.Random(5)
    left = [(r.randrange(200) if not hot or i % 3 else 7, f"l{i}") for i in range(1500)] + [(None, "n")] * 40
    right = [(k, f"r{k}") for k in range(150)] + [(None, "m")]
    return spark.createDataFrame(left, "k bigint, a string"), spark.createDataFrame(right, "id bigint, b string")


@pytest.mark.parametrize("hot", [False, True])
def test_rows_are_those_of_a_join(spark, hot):
    left, right = _sides(spark, hot)
    a = write_bucketed(left, scratch_path(spark, "left"), "k", 8)
    b = write_bucketed(right, scratch_path(spark, "right"), "id", 8)
    assert a.hot == hot and not b.hot
    want = sorted(tuple(x) for x in left.join(right, left.k == right.id).drop("id").collect())
    assert sorted(tuple(x) for x in join_bucketed(a, b, spark).collect()) == want and len(want) > 1000
    assert Bucketed.open(spark, a.path) == a and a.read(spark).count() == 1540
    if hot:
        assert {x["k"] for x in a.frequent(spark).select("k").distinct().collect()} >= {7}


def test_no_shuffle_below_the_join(spark):
    left, right = _sides(spark, False)
    a = write_bucketed(left, scratch_path(spark, "left"), "k", 8)
    b = write_bucketed(right, scratch_path(spark, "right"), "id", 8)
    with sql_conf(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        text = _plan(join_bucketed(a, b, spark))
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert "Exchange" in _plan(left.join(right, left.k == right.id))  # an ordinary join has one
    with pytest.raises(ValueError, match="do not meet"):
        join_bucketed(a, write_bucketed(right, scratch_path(spark, "right"), "id", 4), spark)

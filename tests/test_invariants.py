"""Invariants of the pipeline and sinks on the driver tables (sf0.001)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import aggregates as A
from ledgerlake.operators import quality as Q
from ledgerlake.plans import frames as FR
from ledgerlake.plans import medallion as M
from ledgerlake.session import scratch_path
from ledgerlake.sources import io
from ledgerlake.sources.keyed import KeyedTable
from ledgerlake.sources.tables import Tables

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SF_SMALL)


def test_frame_counts_match_fixtures(t):
    # FIXTURES.md §2 at sf0.001
    assert FR.bronze_frame(t).count() == 6000
    assert FR.merch_frame(t).count() == 10
    assert FR.silver_frame(t).count() == 4460


def test_silver_ids_unique(t):
    s = FR.silver_frame(t)
    assert s.count() == s.select("transaction_id").distinct().count()


def test_quarantine_partitions_the_input(t):
    b = FR.bronze_frame(t)
    kept, rejects = io.quarantine_split(b)
    assert kept.count() + rejects.count() == b.count()


def test_gold_totals_equal_silver_totals(t):
    enr = FR.enr_frame(t)
    silver_rev = enr.where("status = 'COMPLETED'").agg(F.sum("amount")).first()[0]
    daily = A.daily_summary(enr).agg(F.sum("total_revenue"), F.sum("total_txns")).first()
    merch = A.merchant_performance_total(enr).agg(F.sum("total_revenue"), F.sum("txn_count")).first()
    assert round(daily[0], 2) == round(float(silver_rev), 2) == round(merch[0], 2)
    assert daily[1] == merch[1] == enr.count()


def test_idempotent_rerun_replaces_one_partition(spark, t):
    path = scratch_path(spark, "idem")
    s = FR.silver_frame(t).select("transaction_id", "amount", "transaction_date")
    io.write_partitioned(s, path, "transaction_date")
    before = spark.read.parquet(path).count()
    day = s.where(F.col("transaction_date") == F.lit(dt.date(1998, 8, 2)))
    io.write_partitioned(day, path, "transaction_date")
    io.write_partitioned(day, path, "transaction_date")
    assert spark.read.parquet(path).count() == before


def test_failure_gate_halts(spark, t):
    b = FR.bronze_frame(t)
    assert Q.failure_gate(b, 5.0).first().decision == "PROCEED"
    with pytest.raises(RuntimeError):
        Q.enforce_gate(Q.failure_gate(b, 1.0))


def test_missing_source_is_skipped(spark):
    df = io.optional_source_scan(spark, scratch_path(spark, "nothing_here"), io.all_string_schema(["a", "b"]),
                                 header=True)
    assert df.count() == 0 and df.columns == ["a", "b"]


def test_pipeline_stage_error_names_the_stage(spark, t):
    ctx = M.RunContext.new(spark)
    with pytest.raises(M.StageError, match="stage silver"):
        M.safe_run("silver", M.transform_silver, ctx, ctx.path("no_bronze_here"), FR.merch_frame(t),
                   ctx.path("silver"))


def test_insert_if_absent_is_idempotent(spark, t):
    path = scratch_path(spark, "ins")
    b = FR.silver_rules(FR.bronze_frame(t))
    new = io.insert_if_absent(b, path, "transaction_id", FR.dedup_order())
    n1 = KeyedTable(spark, path, "transaction_id").read().count()
    assert new.count() == n1
    assert io.insert_if_absent(b, path, "transaction_id", FR.dedup_order()).count() == 0     # replay: nothing new
    assert new.count() == KeyedTable(spark, path, "transaction_id").read().count() == n1


def test_sql_guard_classes(spark, t):
    from ledgerlake.operators import filters as P
    g = P.sql_text_guard(P.sql_text_extract(P.query_log(t.orders, t.conversations)))
    reasons = {r.reason for r in g.select("reason").distinct().collect()}
    assert {"ok", "empty", "not_select", "forbidden:DROP", "no_known_table"} <= reasons


def test_type_names_parse_as_schema_fields(spark, t):
    from pyspark.sql.types import StructType

    from ledgerlake.plans.queries.scalars import scalar_f15
    fields = [r.field_ddl for r in scalar_f15(t).select("field_ddl").distinct().collect()]   # bounded by columns x types
    assert fields and all(StructType.fromDDL(f).fields for f in fields)

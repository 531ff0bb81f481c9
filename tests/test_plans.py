"""Physical-plan assertions: the plan is the one we want, not just any plan."""

import contextlib
import io
import re

import pytest

from ledgerlake.plans.catalog import load_all
from ledgerlake.sources.tables import Tables

from .conftest import SF_SMALL


def _explain(df, mode) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def plan(df) -> str:
    return _explain(df, "simple")


def formatted(df) -> str:
    return _explain(df, "formatted")


@pytest.fixture(scope="module")
def reg():
    return load_all()


def run(spark, reg, key):
    return reg[key].run(spark, SF_SMALL)


def test_partition_pruned_read_uses_partition_filters(spark, reg):
    df = run(spark, reg, "partition_pruned_read")
    text = formatted(df)
    assert "PartitionFilters: [isnotnull(transaction_date" in text
    assert re.search(r"transaction_date#\d+ = 2001-07-15", text)


def test_enrichment_is_a_broadcast_hash_join(spark, reg):
    assert "BroadcastHashJoin" in plan(run(spark, reg, "enrich_broadcast_left"))


def test_top_1_is_take_ordered(spark, reg):
    assert "TakeOrderedAndProject" in plan(run(spark, reg, "top_1"))


def test_dedup_trims_before_the_shuffle(spark, reg):
    p = formatted(run(spark, reg, "dedup_latest"))
    assert p.count("WindowGroupLimit") >= 2          # partial (map side) + final


def test_filters_and_columns_reach_the_scan(spark, reg):
    p = formatted(run(spark, reg, "status_filter"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in p
    p = formatted(run(spark, reg, "cutoff_after"))
    assert "GreaterThanOrEqual(o_orderdate,2001-01-02T00:00)" in p
    p = formatted(run(spark, reg, "scalar_f10"))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in p


def test_suite_is_one_scan(spark, reg):
    """DQ11: every row-level check of the suite in one aggregate over one scan."""
    scans = re.compile(r"^\(\d+\) Scan parquet", re.M)
    p = formatted(run(spark, reg, "dq_not_null"))
    assert len(scans.findall(p)) == 2     # lineitem + orders of the Bronze frame, once each
    p = formatted(run(spark, reg, "dq_suite"))
    assert len(scans.findall(p)) <= 5     # Bronze (2) + merchant dimension (3): one pass for all checks


@pytest.mark.parametrize("key, table, most", [
    ("dq_unique", "l_partkey", 1), ("dq_suite_soda", "l_partkey", 1), ("dq_suite", "l_partkey", 1), ("dirty_classification", "l_partkey", 2),
    ("treatment_before_after", "l_partkey", 2), ("realism_comparison", "o_orderdate", 1), ("key_conflict_check", "l_partkey", 2),
    ("schema_version_union", "l_partkey", 1), ("silent_break_probe", "l_partkey", 1), ("migrate_version", "l_partkey", 1),
    ("schema_version_diff", "l_partkey", 0), ("surge_vs_other_days", "l_partkey", 0), ("distribution_drift", "o_totalprice", 1),
    ("morning_report_data", "l_partkey", 0), ("alert_rules", "l_partkey", 0)])
def test_passes_over_the_facts(spark, reg, key, table, most):
    """How often the plan reads the fact; 0: from a table that one pass has written."""
    reads = [line for line in plan(run(spark, reg, key)).splitlines() if "FileScan" in line and table in line]
    assert len(reads) <= most, reads


def test_no_python_udf_anywhere(spark, reg):
    for key in ("merchant_performance_total", "sql_text_guard", "pii_columns", "distribution_drift",
                "dirty_classification", "schema_diff"):
        p = plan(run(spark, reg, key))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, key


def test_no_cartesian_products(spark, reg):
    for key in ("schema_diff", "cap_outliers", "incident_duplicates", "alert_rules", "expected_file_status",
                "treatment_before_after", "layer_lineage", "morning_report_data"):
        p = plan(run(spark, reg, key))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key


def test_table_handles_are_lazy(spark):
    t = Tables(spark, SF_SMALL)
    assert t.orders.columns[0] == "o_orderkey"


WRITES = {"parquet_partitioned_write", "partition_pruned_read", "idempotent_overwrite", "run_metadata_sink", "ingest_bronze",
          "transform_silver", "run_gold", "run_medallion", "run_date_pipeline", "run_date_accounting", "quarantine_by_run", "stream_bronze_ingest", "stream_dedup",
          "stream_failure_rate", "stream_silver_upsert", "stream_late_arrivals"}


@pytest.mark.parametrize("key", sorted(set(load_all()) - WRITES))
def test_no_product_and_no_single_task_exchange(spark, reg, key):
    """No key has a product or nested-loop join, and what one task gathers is an aggregate or a few sorted rows."""
    p = plan(run(spark, reg, key))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    lines = p.splitlines()
    for above, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in above:
            assert re.search(r"HashAggregate|ObjectHashAggregate|SortAggregate|LocalLimit|TakeOrdered|Window|Union", below), below


def test_planning_starts_no_job(spark, reg):
    """Nothing is probed or counted to choose a plan: the only jobs read the tables' schemas."""
    context = spark.sparkContext
    tracker = context.statusTracker()
    for key in ("total_count", "merchant_performance_total", "inner_equi_join", "promo_attribution_join", "dq_not_null", "semi_join_keys"):
        context.setJobGroup(f"plan-{key}", key)
        plan(run(spark, reg, key))
        stages = [s for j in tracker.getJobIdsForGroup(f"plan-{key}") for s in tracker.getJobInfo(j).stageIds]
        assert all(tracker.getStageInfo(s).name.startswith("parquet at") for s in stages), key
    context.setJobGroup("tests", "tests")


def test_silver_deduplicates_before_the_order_join(spark, reg):
    p = plan(run(spark, reg, "dedup_latest"))
    join = next(i for i, line in enumerate(p.splitlines()) if re.search(r"(SortMerge|BroadcastHash|ShuffledHash)Join", line))
    group = next(i for i, line in enumerate(p.splitlines()) if "Window [" in line)
    assert group > join  # below it


def test_shuffles_start_fine_and_the_held_back_feed_is_not_one_file(spark, monkeypatch):
    from ledgerlake.streaming import jobs
    landed, land = [], jobs.land_event_files
    monkeypatch.setattr(jobs, "land_event_files", lambda e, path, files=None: landed.append(files) or land(e, path, files))
    load_all()["stream_late_arrivals"].run(spark, SF_SMALL)
    assert landed == [None, None]
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 200

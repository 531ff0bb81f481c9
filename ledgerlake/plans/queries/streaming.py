"""Registered streaming queries: each lands the event table as
arriving files, drains them with ``availableNow`` and returns the sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.plans.catalog import query
from ledgerlake.streaming import jobs as R

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


RUN_ID = "run-0001"


@query("stream_bronze_ingest", f"""
SELECT event_id, ts, user_id, event_type, value, props, TRUE AS has_source, TRUE AS has_time,
       '{RUN_ID}' AS pipeline_run_id FROM events""", frames=False)
def stream_bronze_ingest(t):
    """The events arrive in four files, taken two at a time -> Bronze with source file, ingest
    time and run id."""
    p = R.paths(t.spark, "stream_ingest")
    R.land_event_files(t.events, p["src"], files=4)
    out = R.stream_bronze_ingest(t.spark, p["src"], p["sink"], p["checkpoint"], RUN_ID, files_per_trigger=2)
    return out.select(*EVENT_COLS, F.col("source_file").endswith(".parquet").alias("has_source"),
                      F.col("ingestion_timestamp").isNotNull().alias("has_time"), "pipeline_run_id")


@query("stream_dedup", "SELECT event_id, ts, user_id, event_type, value, props FROM events", frames=False)
def stream_dedup(t):
    """R2: the feed arrives twice in one trigger, then a third time in a later
    run resumed from the checkpoint: repeats within the lateness bound are
    de-duplicated in state, later ones are dropped as late; the sink holds
    every event once."""
    p = R.paths(t.spark, "stream_dedup")
    R.land_event_files(t.events, p["src"])
    R.land_event_files(t.events, p["src"])
    R.stream_dedup(t.spark, p["src"], p["sink"], p["checkpoint"])
    R.land_event_files(t.events, p["src"])
    return R.stream_dedup(t.spark, p["src"], p["sink"], p["checkpoint"]).select(*EVENT_COLS)


@query("stream_late_arrivals", """
SELECT event_id, ts, user_id, event_type, value, props,
       event_id % 40 = 0 AND ts < (SELECT MAX(ts) FROM events WHERE event_id % 40 <> 0) - INTERVAL 1 HOUR AS late FROM events""", frames=False)
def stream_late_arrivals(t):
    """R2 for late first arrivals: one event in forty comes only in a second run, after all others and together with all of them again.
    Every event is kept once; those that came more than an hour behind the newest are marked."""
    p = R.paths(t.spark, "stream_late")
    held_back = F.col("event_id") % 40 == 0
    R.land_event_files(t.events.where(~held_back), p["src"])
    R.stream_dedup_all(t.spark, p["src"], p["sink"], p["checkpoint"])
    R.land_event_files(t.events, p["src"])
    return R.stream_dedup_all(t.spark, p["src"], p["sink"], p["checkpoint"]).select(*EVENT_COLS, "late")


@query("stream_failure_rate", """
WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, COUNT(*) AS events,
                  COUNT(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, events, errors FROM w
WHERE window_start + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR""", frames=False)
def stream_failure_rate(t):
    """Hourly tumbling windows of events and errors, append mode: only
    windows the watermark (max event time - 1 h) has passed are emitted."""
    p = R.paths(t.spark, "stream_rate")
    R.land_event_files(t.events, p["src"])
    return R.stream_failure_rate(t.spark, p["src"], p["sink"], p["checkpoint"])


@query("stream_silver_upsert", "SELECT event_id, ts, user_id, event_type, value, props FROM events", frames=False)
def stream_silver_upsert(t):
    """Micro-batch insert-if-absent into the Silver target, over several batches; a replay of the
    whole feed in a later run (resumed from the checkpoint) adds nothing."""
    p = R.paths(t.spark, "stream_upsert")
    R.land_event_files(t.events, p["src"], files=4)
    R.stream_silver_upsert(t.spark, p["src"], p["sink"], p["checkpoint"], files_per_trigger=2)
    R.land_event_files(t.events, p["src"])
    return R.stream_silver_upsert(t.spark, p["src"], p["sink"], p["checkpoint"]).select(*EVENT_COLS)

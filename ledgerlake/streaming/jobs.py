"""Structured Streaming jobs (R1-R4) over files that arrive in a folder.

Every query keeps its progress in a checkpoint under the shared
``spark.checkpoint.dir``, so a restarted job resumes where it stopped; state
(dedup keys, open windows) is bounded by the watermark. ``availableNow``
drains what has arrived and stops, which is how a scheduled job runs these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path
from ledgerlake.sources.keyed import KeyedTable, Ledger

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def land_event_files(events: DataFrame, path: str, files: int | None = None) -> str:
    """Land the event table in the arrival folder (the producer side), with the table's own
    parallelism or in ``files`` files by event time — appended, as a producer adds files."""
    if files:
        events = events.repartitionByRange(files, "ts")
    events.write.mode("append").parquet(path)
    return path


def _stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path)


def _run(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def stream_bronze_ingest(spark: SparkSession, src: str, sink: str, checkpoint: str, run_id: str = "run-0001",
                         files_per_trigger: int | None = None) -> DataFrame:
    """New files -> Bronze with provenance: source file, time of the micro-batch, run id."""
    s = (_stream(spark, src, files_per_trigger)
         .withColumn("source_file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
         .withColumn("ingestion_timestamp", F.current_timestamp())
         .withColumn("pipeline_run_id", F.lit(run_id)))
    q = (s.writeStream.format("parquet").option("checkpointLocation", checkpoint)
          .trigger(availableNow=True).start(sink))
    _run(q)
    return spark.read.parquet(sink)


def stream_dedup(spark: SparkSession, src: str, sink: str, checkpoint: str, lateness: str = "1 hour",
                 files_per_trigger: int | None = None) -> DataFrame:
    """R2: drop repeated event ids that arrive within the lateness bound;
    dedup state per id is released once the watermark passes it, and copies
    arriving later than the bound are dropped as late data."""
    s = (_stream(spark, src, files_per_trigger)
         .withColumn("event_time", F.col("ts").cast("timestamp"))
         .withWatermark("event_time", lateness)
         .dropDuplicatesWithinWatermark(["event_id"]))
    q = (s.drop("event_time").writeStream.format("parquet").option("checkpointLocation", checkpoint)
          .trigger(availableNow=True).start(sink))
    _run(q)
    return spark.read.parquet(sink)


def stream_dedup_all(spark: SparkSession, src: str, target: str, checkpoint: str, lateness: str = "1 hour",
                     files_per_trigger: int | None = None) -> DataFrame:
    """R2 without a bound on lateness: a first arrival is kept however late it comes, with ``late`` true if it is older than the newest
    event of the batches before by more than ``lateness``, and a repeat is dropped however late. What has been seen is the target itself, a
    keyed table whose filters say which of its files to look into, so no state grows in memory."""
    table = KeyedTable(spark, target, "event_id")
    newest = Ledger(spark, f"{target}/newest", "epoch bigint, ts timestamp_ntz")

    def keep(batch: DataFrame, epoch_id: int) -> None:
        seen = [r["ts"] for r in newest.rows() if r["epoch"] < epoch_id and r["ts"] is not None]
        bound = F.lit(max(seen)) - F.expr(f"INTERVAL {lateness}") if seen else F.lit(None)
        marked = batch.withColumn("late", F.coalesce(F.col("ts") < bound.cast("timestamp_ntz"), F.lit(False)))
        table.insert_absent(marked, [F.col("ts"), F.col("event_type"), F.col("value")], writer=checkpoint, epoch=epoch_id)
        if epoch_id not in {r["epoch"] for r in newest.rows()}:
            newest.commit(epoch=epoch_id, ts=batch.agg(F.max("ts")).first()[0])

    q = (_stream(spark, src, files_per_trigger).writeStream.foreachBatch(keep)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _run(q)
    return table.read()


def stream_failure_rate(spark: SparkSession, src: str, sink: str, checkpoint: str,
                        window: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """Tumbling-window error rate, append mode: a window is emitted once
    the watermark passes its end, and its state is dropped."""
    s = (_stream(spark, src)
         .withColumn("event_time", F.col("ts").cast("timestamp"))
         .withWatermark("event_time", lateness)
         .groupBy(F.window("event_time", window).alias("w"))
         .agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_type") == "error").alias("errors")))
    out = s.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                   F.col("w.end").cast("timestamp_ntz").alias("window_end"), "events", "errors")
    q = (out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(sink))
    _run(q)
    return spark.read.parquet(sink)


def stream_silver_upsert(spark: SparkSession, src: str, target: str, checkpoint: str,
                         files_per_trigger: int | None = None) -> DataFrame:
    """Each micro-batch is de-duplicated and inserted only for ids not yet in the target (``foreachBatch`` into a
    :class:`ledgerlake.sources.keyed.KeyedTable`). The target's ledger knows the batches of this checkpoint: one that
    failed before its commit is done again over what it left, one that failed after it changes nothing."""
    table = KeyedTable(spark, target, "event_id")

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        table.insert_absent(batch, [F.col("ts"), F.col("event_type"), F.col("value")], writer=checkpoint, epoch=epoch_id)

    q = (_stream(spark, src, files_per_trigger).writeStream.foreachBatch(upsert)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _run(q)
    return table.read()


def paths(spark: SparkSession, name: str) -> dict[str, str]:
    base = scratch_path(spark, name)
    return {"src": f"{base}/incoming", "sink": f"{base}/sink", "checkpoint": f"{base}/_checkpoint"}

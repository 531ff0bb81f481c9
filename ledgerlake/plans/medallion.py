"""The Bronze -> Silver -> Gold pipeline (L1-L8) as Spark jobs.

Stages are plain ``DataFrame -> DataFrame`` steps joined by files in the
shared folder (stages share tables, not plans, so a lost executor only
re-runs the current stage). Row counts per stage come from ``observe()``
on the write itself — no extra ``count()`` job per step — and every write
of a date-partitioned table is a dynamic partition overwrite, so a re-run
replaces only the dates it carries.

Runs by date account for every landed row. Rows are dated by a cast, so a date in another spelling belongs to its
day; rows without a date have a table of their own, by the file they came in. The *manifest* has the rows of each
landed file by date: it is filled once per file, tells a run which files hold its date, and gives
landed = rows of every date + undated. Rejects are kept by date: input = kept + rejected, whatever ran before or after.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.operators import aggregates as A
from ledgerlake.operators import incremental as INC
from ledgerlake.operators import quality as Q
from ledgerlake.plans import frames as FR
from ledgerlake.sources import io
from ledgerlake.sources.keyed import KeyedTable
from ledgerlake.session import materialize, releases_shuffles, scratch_path

log = logging.getLogger("ledgerlake.medallion")

# The landing (CSV) layout of the transaction feed, all strings.
LANDING_COLUMNS = ["transaction_id", "amount", "status", "merchant_id", "customer_id", "transaction_date",
                   "payment_method", "ingestion_ts", "tie1", "tie2", "tie3", "tie4", "return_flag"]
BRONZE_TYPES = {"amount": "decimal(18,2)", "merchant_id": "bigint", "customer_id": "bigint",
                "transaction_date": "date", "ingestion_ts": "timestamp_ntz", "tie1": "bigint", "tie2": "double",
                "tie3": "double", "tie4": "double"}
GATE_PCT = 5.0


class StageError(RuntimeError):
    """A pipeline failure, named by the stage it happened in."""


@dataclass
class RunContext:
    spark: SparkSession
    run_id: str
    run_ts: dt.datetime
    root: str
    run_date: dt.date | None = None
    gate_pct: float = GATE_PCT
    counts: dict = field(default_factory=dict)

    @classmethod
    def new(cls, spark: SparkSession, run_id: str = "run-0001", run_ts: dt.datetime | None = None,
            run_date: dt.date | None = None, gate_pct: float = GATE_PCT, root: str | None = None) -> "RunContext":
        return cls(spark, run_id, run_ts or dt.datetime(2001, 8, 2, 2, 0, 0), root or scratch_path(spark, "medallion"),
                   run_date, gate_pct)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def safe_run(stage: str, fn, *args, **kwargs):
    """Run a stage; re-raise any failure with the stage name attached."""
    try:
        return fn(*args, **kwargs)
    except Exception as e:  # noqa: BLE001
        raise StageError(f"stage {stage} failed: {e}") from e


@releases_shuffles
def land_feed(t, path: str) -> str:
    """The raw feed as it lands: BRONZE rows written as header CSV, all strings. A file is gzipped: it holds what a task of the
    join had, so it is small enough to be read by one task."""
    b = FR.bronze_frame(t)
    return io.write_csv(b.select(*[F.col(c).cast("string").alias(c) for c in LANDING_COLUMNS]), path, "gzip")


MERCHANT_TYPES = {"merchant_id": "bigint", "merchant_name": "string", "category": "string", "city": "string"}


def land_merchants(t, path: str) -> str:
    """The merchant feed as it lands: header CSV, all strings."""
    return io.write_csv(FR.merch_frame(t).select(*[F.col(c).cast("string").alias(c) for c in MERCHANT_TYPES]), path)


def ingest_merchants(ctx: RunContext, source: str, bronze_path: str) -> DataFrame:
    """L1 for the dimension: CSV -> Bronze with provenance, replaced as a whole; typed as Silver reads it."""
    raw = io.optional_source_scan(ctx.spark, source, io.all_string_schema(list(MERCHANT_TYPES)), header=True)
    io.with_provenance(raw, ctx.run_id, ctx.run_ts).write.mode("overwrite").parquet(bronze_path)
    return ctx.spark.read.parquet(bronze_path).select(*[F.col(c).try_cast(k).alias(c) for c, k in MERCHANT_TYPES.items()])


UNDATED = "undated"
BRONZE_COLUMNS = [*LANDING_COLUMNS, "ingestion_timestamp", "source_file", "pipeline_run_id"]
DAY = "bronze_date"


def bronze_date() -> Column:
    """The day that a landed row belongs to, however its date is spelled; UNDATED if it has none."""
    return F.coalesce(F.col("transaction_date").try_cast("date").cast("string"), F.lit(UNDATED))


def landed_files(ctx: RunContext, source: str) -> dict[str, tuple[str, str]]:
    """name -> (path, version) of a landing's files; a file that is replaced has another version. Their contents are not read."""
    found = ctx.spark.read.format("binaryFile").option("pathGlobFilter", "*.csv{,.gz}").load(source)
    rows = found.select("path", "length", "modificationTime").collect()
    return {r["path"].rsplit("/", 1)[-1]: (r["path"], f"{r['length']} {r['modificationTime']}") for r in rows}


def manifest(ctx: RunContext) -> DataFrame:
    """(source_file, version, bronze_date, rows) of every file that has been counted."""
    schema = f"version string, {DAY} string, rows bigint, source_file string"
    return io.optional_source_scan(ctx.spark, ctx.path("manifest"), StructType.fromDDL(schema), "parquet")


def update_manifest(ctx: RunContext, files: dict[str, tuple[str, str]], scan: Callable[[list[str]], DataFrame]) -> None:
    """Counts the files that are new or have been replaced, and takes their undated rows, in one pass over them. Others are not read."""
    known = counted_files(ctx)
    new = sorted(f for f, (_, version) in files.items() if known.get(f) != version)
    if not new:
        return
    rows = scan([files[f][0] for f in new]).withColumn(DAY, bronze_date())
    undated_row = F.when(F.col(DAY) == UNDATED, F.struct(*BRONZE_COLUMNS))
    seen = materialize(rows.groupBy("source_file", DAY, undated_row.alias("row")).agg(F.count(F.lit(1)).alias("rows")), "landed_rows")
    lost = seen.where(F.col(DAY) == UNDATED).select(F.explode(F.sequence(F.lit(1).cast("bigint"), "rows")), "row.*").drop("col")  # as often as landed
    io.write_partitioned(lost, ctx.path(UNDATED), "source_file")
    for f in sorted(known.keys() & set(new)):  # a replaced file must not keep undated rows that it has no longer
        io.replace_partition(lost.where(F.col("source_file") == f), ctx.path(UNDATED), "source_file", f)
    write_manifest(ctx, files, new, seen)


def counted_files(ctx: RunContext) -> dict[str, str]:
    """name -> version of the files that the manifest has."""
    return {r["source_file"]: r["version"] for r in manifest(ctx).select("source_file", "version").distinct().collect()}


def write_manifest(ctx: RunContext, files: dict[str, tuple[str, str]], new: list[str], counts: DataFrame) -> None:
    """The manifest of ``new`` files from (source_file, bronze_date, rows), of which a file and date may have several."""
    versions = ctx.spark.createDataFrame([(f, files[f][1]) for f in new], "source_file string, version string")
    counted = counts.groupBy("source_file", DAY).agg(F.sum("rows").alias("rows")).join(F.broadcast(versions), "source_file")
    counted.write.mode("overwrite").partitionBy("source_file").parquet(ctx.path("manifest"))


def manifest_of_bronze(ctx: RunContext, files: dict[str, tuple[str, str]], scan: Callable[[list[str]], DataFrame], bronze_path: str, lost: int) -> None:
    """The manifest of a first full load, from the Bronze that it has just written; the files are read again only if some of
    their rows, ``lost``, have no date."""
    if lost:
        rows = scan(sorted(path for path, _ in files.values())).where(bronze_date() == UNDATED)
        io.write_partitioned(rows.select(*BRONZE_COLUMNS), ctx.path(UNDATED), "source_file")
    dated = io.optional_source_scan(ctx.spark, bronze_path, io.all_string_schema([*BRONZE_COLUMNS, DAY]), "parquet").select("source_file", DAY)
    none = io.optional_source_scan(ctx.spark, ctx.path(UNDATED), io.all_string_schema(BRONZE_COLUMNS), "parquet") if lost else dated.limit(0)
    both = dated.unionByName(none.select("source_file", F.lit(UNDATED).alias(DAY)))
    write_manifest(ctx, files, sorted(files), both.groupBy("source_file", DAY).agg(F.count(F.lit(1)).alias("rows")))


def undated(ctx: RunContext) -> DataFrame:
    """Landed rows without a date, of all files or, by run date, of the files that hold the date."""
    rows = io.optional_source_scan(ctx.spark, ctx.path(UNDATED), io.all_string_schema(BRONZE_COLUMNS), "parquet")
    if ctx.run_date is None:
        return rows
    return rows.join(manifest(ctx).where(F.col(DAY) == str(ctx.run_date)).select("source_file"), "source_file", "left_semi")


@releases_shuffles
def ingest_bronze(ctx: RunContext, source: str, bronze_path: str) -> DataFrame:
    """L1: CSV -> Bronze: all-string scan (S1), missing source skipped (S8), provenance (S2), Parquet partitioned by
    day (S3). A first full load parses the feed once. By run date only the files that the manifest has for the day are read, and the day is replaced."""
    header = io.csv_header(ctx.spark, source)
    files: list[str] = []
    landed: dict[str, tuple[str, str]] = {}
    first = False  # a full load into a new Bronze: its counts come from what it writes

    def scan(paths: list[str]) -> DataFrame:
        return io.with_provenance(io.csv_bronze_scan(ctx.spark, paths, LANDING_COLUMNS), ctx.run_id, ctx.run_ts)

    if header is None:
        log.warning("source %s missing: skipping", source)
    else:
        Q.require_columns(header, LANDING_COLUMNS)
        landed = landed_files(ctx, source)
        first = ctx.run_date is None and not counted_files(ctx) and io.is_missing(ctx.spark, bronze_path)
        if not first:
            update_manifest(ctx, landed, scan)
        if ctx.run_date is not None:
            holds = {r["source_file"] for r in manifest(ctx).where(F.col(DAY) == str(ctx.run_date)).select("source_file").collect()}
            landed = {f: v for f, v in landed.items() if f in holds}
        files = sorted(path for path, _ in landed.values())
    rows = scan(files).withColumn(DAY, bronze_date()) if files else ctx.spark.createDataFrame([], io.all_string_schema([*BRONZE_COLUMNS, DAY]))
    wanted = F.col(DAY) != UNDATED if ctx.run_date is None else F.col(DAY) == str(ctx.run_date)
    obs = Observation("bronze")
    rows = rows.observe(obs, F.count_if(wanted).alias("input"), F.count_if(F.col(DAY) == UNDATED).alias("undated")).where(wanted)
    if ctx.run_date is None:
        io.write_partitioned(rows, bronze_path, DAY)
    else:
        io.replace_partition(rows, bronze_path, DAY, ctx.run_date)
    if first and landed:
        manifest_of_bronze(ctx, landed, scan, bronze_path, io.observed(obs, "undated"))
    ctx.counts.update(input=io.observed(obs, "input"), undated=undated(ctx).count())
    return read_bronze(ctx, bronze_path)


def read_bronze(ctx: RunContext, bronze_path: str) -> DataFrame:
    """Bronze's dated rows, of the run date if there is one."""
    schema = io.all_string_schema([*BRONZE_COLUMNS, DAY])
    df = ctx.spark.read.schema(schema).parquet(bronze_path)
    if ctx.run_date is not None:
        df = df.where(F.col(DAY) == F.lit(str(ctx.run_date)))   # partition pruning
    return df.drop(DAY)


def typed(bronze: DataFrame) -> DataFrame:
    """``try_cast`` to the Silver types; unparsable values become null."""
    return bronze.select(*[F.col(c).try_cast(BRONZE_TYPES[c]).alias(c) if c in BRONZE_TYPES else F.col(c)
                           for c in LANDING_COLUMNS])


REJECT_COLUMNS = [*LANDING_COLUMNS, "reject_reason"]


def quarantine(ctx: RunContext) -> DataFrame:
    """Every reject: (run_date, columns, reason), those of the days as their last run left them and the undated rows."""
    days = io.optional_source_scan(ctx.spark, ctx.path("quarantine"), io.all_string_schema([*REJECT_COLUMNS, "run_date"]), "parquet")
    _, lost = io.quarantine_split(typed(undated(replace(ctx, run_date=None))))
    lost = lost.select(*[F.col(c).cast("string").alias(c) for c in REJECT_COLUMNS], F.lit(UNDATED).alias("run_date"))
    return days.unionByName(lost)


@releases_shuffles
def transform_silver(ctx: RunContext, bronze_path: str, merch: DataFrame, silver_path: str) -> DataFrame:
    """L2: Bronze -> Silver: cast (P2), gate (DQ20), filter (P3), dedup (W1),
    enrich + flag (J1, P10), overwrite of the dates written (S5). The gate also sees the undated rows that came with the
    run's files. Below it, rows that fail a rule or a cast go to the day's quarantine with their reason (S13): input = filtered + rejected."""
    b = typed(read_bronze(ctx, bronze_path))
    gate = Q.enforce_gate(Q.failure_gate(b.unionByName(typed(undated(ctx))), ctx.gate_pct))          # one aggregate; raises on HALT
    ctx.counts["gate_failed_pct"] = gate["failed_pct"]
    obs = Observation("silver")
    kept, rejects = io.quarantine_split(b)
    filtered = kept.observe(obs, F.count(F.lit(1)).alias("after_filter"))
    silver = FR.enrich(FR.dedup_latest(filtered).drop("rn"), merch)
    obs_out = Observation("silver_out")
    silver = silver.observe(obs_out, F.count(F.lit(1)).alias("output"))
    obs_bad = Observation("quarantine")
    rejects = rejects.observe(obs_bad, F.count(F.lit(1)).alias("rejected"))
    rejects = rejects.select(*[F.col(c).cast("string").alias(c) for c in REJECT_COLUMNS]).withColumn("run_date", F.col("transaction_date"))
    if ctx.run_date is None:
        io.write_partitioned(silver, silver_path, "transaction_date")
        rejects.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", io.STORED).partitionBy("run_date").parquet(ctx.path("quarantine"))
    else:
        io.replace_partition(silver, silver_path, "transaction_date", ctx.run_date)
        io.replace_partition(rejects, ctx.path("quarantine"), "run_date", ctx.run_date)
    ctx.counts.update({n: io.observed(o, n) for o, n in ((obs, "after_filter"), (obs_out, "output"), (obs_bad, "rejected"))})
    return read_silver(ctx, silver_path)


def accounting(ctx: RunContext) -> DataFrame:
    """(run_date, landed, ingested, kept, rejected) of every day that landed and of the undated rows; a day that has not run has nulls.
    landed = ingested = kept + rejected for the days that have run; undated rows are all rejected."""
    days = manifest(ctx).groupBy(F.col(DAY).alias("run_date")).agg(F.sum("rows").alias("landed"))
    schema = io.all_string_schema([*BRONZE_COLUMNS, DAY])
    ran = io.optional_source_scan(ctx.spark, ctx.path("bronze"), schema, "parquet").groupBy(F.col(DAY).alias("run_date")).agg(F.count(F.lit(1)).alias("ingested"))
    lost = days.where(F.col("run_date") == UNDATED).select("run_date", F.lit(0).cast("bigint").alias("ingested"))
    bad = quarantine(ctx).groupBy("run_date").agg(F.count(F.lit(1)).alias("rejected"))
    joined = days.join(ran.unionByName(lost), "run_date", "left").join(bad, "run_date", "left")
    rejected = F.when(F.col("ingested").isNotNull(), F.coalesce("rejected", F.lit(0)))
    return joined.select("run_date", "landed", "ingested", F.when(F.col("run_date") == UNDATED, 0).otherwise(F.col("ingested") - rejected).cast("bigint").alias("kept"),
                         rejected.alias("rejected"))


def read_silver(ctx: RunContext, silver_path: str) -> DataFrame:
    df = ctx.spark.read.parquet(silver_path)
    if ctx.run_date is not None:
        df = df.where(F.col("transaction_date") == F.lit(ctx.run_date))
    return df


@releases_shuffles
def run_gold(ctx: RunContext, silver_path: str, gold_dir: str) -> dict[str, str]:
    """L3: Silver -> merchant_performance (by date), customer_ltv, daily_summary (by date). By run date each is brought up to
    date from that date alone: two replace their day, customer_ltv merges the day into its state (operators/incremental.py)."""
    s = read_silver(ctx, silver_path)
    paths = {"merchant_performance": f"{gold_dir}/merchant_performance",
             "customer_ltv": f"{gold_dir}/customer_ltv",
             "daily_summary": f"{gold_dir}/daily_summary"}
    state = INC.ltv_state(ctx.spark, f"{gold_dir}/customer_ltv_state")
    totals = state.apply(s.where(A.is_completed()), None if ctx.run_date is None else [ctx.run_date])
    INC.customer_ltv(totals).write.mode("overwrite").parquet(paths["customer_ltv"])
    for name, table in (("merchant_performance", A.merchant_performance(s)), ("daily_summary", A.daily_summary(s))):
        if ctx.run_date is None:
            io.write_partitioned(table, paths[name], "report_date")
        else:
            io.replace_partition(table, paths[name], "report_date", ctx.run_date)
    return paths


def run_medallion(ctx: RunContext, t) -> DataFrame:
    """L4: every stage in order, errors named by stage and re-raised, stage
    counts from observations, one metadata row written by Spark (S9)."""
    started = dt.datetime.now()
    status, error = "SUCCESS", None
    gold = {}
    try:
        src = safe_run("land", land_feed, t, ctx.path("landing"))
        safe_run("bronze", ingest_bronze, ctx, src, ctx.path("bronze"))
        merch = safe_run("merchants", ingest_merchants, ctx, safe_run("land", land_merchants, t, ctx.path("landing_merchants")),
                         ctx.path("bronze_merchants"))
        safe_run("silver", transform_silver, ctx, ctx.path("bronze"), merch, ctx.path("silver"))
        gold = safe_run("gold", run_gold, ctx, ctx.path("silver"), ctx.path("gold"))
    except StageError as e:
        status, error = "FAILED", str(e)
    meta = {"run_id": ctx.run_id, "status": status, "error_message": error,
            "run_date": str(ctx.run_date) if ctx.run_date else "all",
            "input_rows": int(ctx.counts.get("input", 0)) + int(ctx.counts.get("undated", 0)), "after_filter_rows": int(ctx.counts.get("after_filter", 0)),
            "output_rows": int(ctx.counts.get("output", 0)), "gold_tables": len(gold),
            "started_at": started.isoformat(), "completed_at": dt.datetime.now().isoformat()}
    out = io.run_metadata_sink(ctx.spark, ctx.path("run_metadata"), meta)
    if status != "SUCCESS":
        raise StageError(error)
    return out


def stage_counts(bronze: DataFrame, merch: DataFrame) -> DataFrame:
    """DQ13: rows of each stage, observed where the stage stands while one job runs through all of them. A join
    that lost or multiplied rows would show."""
    stages = ["input", "after_cast", "after_filter", "after_dedup", "after_enrich", "output"]
    seen = {s: Observation(s) for s in stages}

    def watch(df: DataFrame, stage: str) -> DataFrame:
        return df.observe(seen[stage], F.count(F.lit(1)).alias("rows"))

    cast = watch(watch(bronze, "input").where(F.col("amount").isNotNull() & F.col("transaction_date").isNotNull()), "after_cast")
    one = watch(FR.dedup_latest(watch(FR.silver_rules(cast), "after_filter")), "after_dedup")
    out = watch(watch(FR.enrich(one, merch), "after_enrich").drop("rn"), "output")
    out.write.format("noop").mode("overwrite").save()
    return bronze.sparkSession.createDataFrame([(s, int(seen[s].get["rows"])) for s in stages], "stage string, rows bigint")


def stg_transactions(bronze: DataFrame, test_prefix: str = "TEST_") -> DataFrame:
    """The staging model — business names, explicit casts, lower-case
    status (staging only, X11), literal-prefix exclusion (X13), surrogate key."""
    from ledgerlake.functions.scalars import surrogate_key
    b = bronze.where(~F.startswith(F.col("merchant_id").cast("string"), F.lit(test_prefix)))
    return b.select(
        surrogate_key("transaction_id", "merchant_id", "transaction_date").alias("transaction_sk"),
        "transaction_id", F.col("amount").cast("string").try_cast("decimal(10,2)").alias("amount_usd"),
        F.lower("status").alias("status"), F.col("merchant_id").cast("string").alias("merchant_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("transaction_date").cast("date").alias("transaction_date"),
        F.trim("payment_method").alias("payment_method"))


def incremental_load(spark: SparkSession, bronze: DataFrame, target_path: str, cutoff) -> DataFrame:
    """Rows after the cutoff (P7) -> Silver rules (P3) -> insert-if-absent
    (S11) into a target that already holds the rows up to the cutoff; the target's rows."""
    table = KeyedTable(spark, target_path, "transaction_id")
    silver = FR.silver_rules(bronze)
    table.insert_absent(silver.where(F.col("transaction_date") <= F.lit(cutoff)), FR.dedup_order())
    table.insert_absent(silver.where(F.col("transaction_date") > F.lit(cutoff)), FR.dedup_order())
    return table.read()

"""Registered scan / source / sink queries and pipelines (§2.15).

Sinks write to a fresh folder under ``spark.checkpoint.dir`` and return a
frame read back from the written files, so the oracle checks what landed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.operators import aggregates as A
from ledgerlake.plans import frames as FR
from ledgerlake.plans import medallion as M
from ledgerlake.plans.catalog import query
from ledgerlake.plans.oracle import round_sql
from ledgerlake.plans.queries.aggregates import FAIL_SQL, REV_SQL
from ledgerlake.session import materialize, scratch_path
from ledgerlake.sources import io
from ledgerlake.sources.keyed import KeyedTable

RUN_ID = "run-0001"
RUN_TS = dt.datetime(2001, 8, 2, 2, 0, 0)
RUN_DATE = dt.date(2001, 7, 15)
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDERS_CSV_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders"""


def _orders_as_strings(t):
    o = t.orders
    return o.select(F.col("o_orderkey").cast("string").alias("o_orderkey"),
                    F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderstatus",
                    F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"),
                    F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"), "o_orderpriority")


def _land_orders(t):
    path = scratch_path(t.spark, "orders_csv")
    return io.write_csv(_orders_as_strings(t), path)


@query("csv_bronze_scan", ORDERS_CSV_SQL, frames=False)
def csv_bronze_scan(t):
    """Orders landed as header CSV, scanned with an all-string schema."""
    return io.csv_bronze_scan(t.spark, _land_orders(t), ORDER_COLS)


@query("bronze_provenance", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, TIMESTAMP '{RUN_TS}' AS ingestion_timestamp,
       '{RUN_ID}' AS pipeline_run_id, TRUE AS source_is_csv FROM orders""", frames=False)
def bronze_provenance(t):
    """The run's ingestion timestamp, the source file name (from the
    file metadata column) and the run id on every row."""
    df = io.with_provenance(io.csv_bronze_scan(t.spark, _land_orders(t), ORDER_COLS), RUN_ID, RUN_TS)
    return df.select("o_orderkey", "ingestion_timestamp", "pipeline_run_id",
                     (F.col("source_file").startswith("part-") & F.col("source_file").endswith(".csv"))
                     .alias("source_is_csv"))


SILVER_OUT = ["transaction_id", "amount", "status", "merchant_id", "customer_id", "transaction_date", "payment_method"]


def _write_silver(t):
    path = scratch_path(t.spark, "silver")
    io.write_partitioned(FR.silver_frame(t).select(*SILVER_OUT), path, "transaction_date")
    return path


@query("parquet_partitioned_write", "SELECT transaction_date, COUNT(*) AS rows FROM silver GROUP BY 1")
def parquet_partitioned_write(t):
    """S3: Silver written as Parquet partitioned by date, read back; rows per partition."""
    df = t.spark.read.parquet(_write_silver(t))
    return df.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("rows"))


@query("partition_pruned_read", f"""
SELECT transaction_id, amount, transaction_date FROM silver WHERE transaction_date = DATE '{RUN_DATE}'""")
def partition_pruned_read(t):
    """One date read from the partitioned table (PartitionFilters in the scan)."""
    df = io.read_partition(t.spark, _write_silver(t), "transaction_date", RUN_DATE)
    return df.select("transaction_id", "amount", "transaction_date")


@query("idempotent_overwrite", "SELECT transaction_date, COUNT(*) AS rows FROM silver GROUP BY 1")
def idempotent_overwrite(t):
    """Re-running the run date twice replaces only that partition; every
    other date is untouched and counts stay equal to Silver."""
    path = _write_silver(t)
    day = FR.silver_frame(t).select(*SILVER_OUT).where(F.col("transaction_date") == F.lit(RUN_DATE))
    io.write_partitioned(day, path, "transaction_date")
    io.write_partitioned(day, path, "transaction_date")
    return t.spark.read.parquet(path).groupBy("transaction_date").agg(F.count(F.lit(1)).alias("rows"))


@query("named_table_scan", "SELECT * FROM orders", frames=False)
def named_table_scan(t):
    """``SELECT *`` of a catalog table (temp view) via ``spark.table``."""
    t.orders.createOrReplaceTempView("orders")
    return t.spark.table("orders")


@query("rows_to_table", "SELECT * FROM ord")
def rows_to_table(t):
    """Rows landed as JSON lines, bulk-loaded under a declared schema."""
    ddl = ("transaction_id BIGINT, amount DECIMAL(18,2), status STRING, customer_id BIGINT, "
           "transaction_date DATE, payment_method STRING")
    return io.load_json_table(t.spark, FR.ord_frame(t), scratch_path(t.spark, "rows_json"), ddl)


@query("optional_source_scan", ORDERS_CSV_SQL, frames=False)
def optional_source_scan(t):
    """Two days' sources, one missing: the missing one is skipped with a
    warning (empty typed frame), the present one is read."""
    present = _land_orders(t)
    missing = scratch_path(t.spark, "no_such_day")
    schema = io.all_string_schema(ORDER_COLS)
    return (io.optional_source_scan(t.spark, present, schema, header=True)
              .unionByName(io.optional_source_scan(t.spark, missing, schema, header=True)))


@query("run_metadata_sink", f"""
SELECT '{RUN_ID}' AS run_id, 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_message,
       (SELECT COUNT(*) FROM bronze) AS input_rows,
       (SELECT COUNT(*) FROM bronze WHERE transaction_id IS NOT NULL AND amount >= 0) AS after_filter_rows,
       (SELECT COUNT(*) FROM enr) AS output_rows, 3 AS gold_tables""")
def run_metadata_sink(t):
    """The run's metadata row (stage counts from observations) written as
    JSON by Spark and read back."""
    ctx = M.RunContext.new(t.spark, RUN_ID, RUN_TS)
    meta = M.run_medallion(ctx, t)
    return meta.select("run_id", "status", F.col("error_message").cast("string").alias("error_message"),
                       "input_rows", "after_filter_rows", "output_rows", "gold_tables")


@query("partner_feed", """
SELECT CAST(merchant_id % 3 AS INTEGER) AS partner_id, COUNT(*) AS rows,
       COUNT(DISTINCT sha256(CAST(customer_id AS VARCHAR))) AS customers
FROM enr GROUP BY 1""")
def partner_feed(t):
    """One output per partner (merchant_id mod 3), customer ids hashed."""
    df = io.partner_feed(FR.enr_frame(t), scratch_path(t.spark, "partner_feed"))
    return df.groupBy("partner_id").agg(F.count(F.lit(1)).alias("rows"),
                                        F.count_distinct("customer_hash").alias("customers"))


VALID = "transaction_id IS NOT NULL AND amount >= 0"


@query("insert_if_absent", f"""
WITH b1 AS (SELECT DISTINCT transaction_id FROM bronze WHERE {VALID} AND tie1 % 2 = 0)
SELECT transaction_id, 1 AS load FROM b1
UNION ALL SELECT DISTINCT transaction_id, 2 FROM bronze WHERE {VALID}
  AND transaction_id NOT IN (SELECT transaction_id FROM b1)""")
def insert_if_absent(t):
    """Two batches (even part keys, then everything) loaded with INSERT OR
    IGNORE semantics: each batch de-duplicated, existing keys skipped."""
    b = materialize(FR.silver_rules(FR.bronze_frame(t)), "insert_feed")
    path = scratch_path(t.spark, "insert_target")
    io.insert_if_absent(b.where(F.col("tie1") % 2 == 0).withColumn("load", F.lit(1)), path, "transaction_id", FR.dedup_order())
    io.insert_if_absent(b.withColumn("load", F.lit(2)), path, "transaction_id", FR.dedup_order())
    return KeyedTable(t.spark, path, "transaction_id").read().select("transaction_id", "load")


LATE = dt.date(2001, 7, 31)


@query("keyed_insert", f"""
WITH s AS (SELECT transaction_id, transaction_date, tie1 FROM bronze WHERE {VALID}),
a AS (SELECT DISTINCT transaction_id FROM s WHERE transaction_date <= DATE '{LATE}' AND tie1 % 97 <> 0),
c AS (SELECT DISTINCT transaction_id FROM s WHERE transaction_date > DATE '{LATE}' OR tie1 % 97 = 0)
SELECT 0 AS load, COUNT(*) AS rows, TRUE AS reads_follow_keys FROM a
UNION ALL SELECT 1, COUNT(*), TRUE FROM c WHERE transaction_id NOT IN (SELECT transaction_id FROM a)
UNION ALL SELECT 2, 0, TRUE UNION ALL SELECT 3, 0, TRUE
UNION ALL SELECT 4, COUNT(*), TRUE FROM s WHERE tie1 % 101 = 0 AND transaction_id NOT IN (SELECT transaction_id FROM a UNION SELECT transaction_id FROM c)""")
def keyed_insert(t):
    """S11/L6 as a daily job: a table of all days but the last, the late rows into it, the same batch again, an empty batch, then, after
    compaction, a sample of what is there. Rows inserted per load, and whether it read no more buckets of loads than its keys can stand in
    (each key of the target in one; a false positive is at most one in fifty)."""
    b = materialize(FR.silver_rules(FR.bronze_frame(t)), "insert_feed")  # read by every batch
    table = KeyedTable(t.spark, scratch_path(t.spark, "keyed_target"), "transaction_id")
    late = (F.col("transaction_date") > F.lit(LATE)) | (F.col("tie1") % 97 == 0)
    batches = [b.where(~late), b.where(late), b.where(late), b.limit(0), b.where(F.col("tie1") % 101 == 0)]
    out = []
    for n, batch in enumerate(batches):
        if n == 4:
            table.compact()
        keys = materialize(batch.select("transaction_id").distinct(), "insert_keys")
        meant = table.present(keys)[0].count() + keys.count() // 50 + 1 if table.loads() else 0
        load = table.insert_absent(batch, FR.dedup_order())
        out.append((n, load.rows, load.candidates <= min(load.partitions, meant)))
    return t.spark.createDataFrame(out, "load int, rows bigint, reads_follow_keys boolean")


@query("key_conflict_check", """
WITH b AS (SELECT transaction_id FROM bronze WHERE transaction_id IS NOT NULL AND tie1 % 2 = 1),
tg AS (SELECT transaction_id FROM silver WHERE tie1 % 2 = 0)
SELECT transaction_id, 'duplicate_in_batch' AS reason, COUNT(*) AS occurrences FROM b GROUP BY 1 HAVING COUNT(*) > 1
UNION ALL SELECT transaction_id, 'exists_in_target', COUNT(*) FROM b
WHERE transaction_id IN (SELECT transaction_id FROM tg) GROUP BY 1""")
def key_conflict_check(t):
    """Keys of an incoming batch (odd part keys) that would break the
    primary key: duplicated within the batch or already in the target."""
    batch = FR.bronze_frame(t).where(F.col("tie1") % 2 == 1)
    target = FR.silver_frame(t).where(F.col("tie1") % 2 == 0)
    return io.key_conflicts(batch, target, "transaction_id")


REASON_SQL = """CASE WHEN transaction_id IS NULL THEN 'null_id' WHEN amount IS NULL THEN 'bad_amount'
            WHEN amount < 0 THEN 'negative_amount' WHEN transaction_date IS NULL THEN 'bad_date' END"""


@query("quarantine_split", f"""
SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, tie1, {REASON_SQL} AS reject_reason FROM bronze""")
def quarantine_split(t):
    """Rows failing the rules go to a rejects frame with a reason; both halves, kept and rejected, are the input."""
    kept, rejects = io.quarantine_split(FR.bronze_frame(t))
    both = kept.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(rejects)
    return both.select("transaction_id", F.col("amount").cast("double").alias("amount"), "tie1", "reject_reason")


@query("quarantine_bad_casts", f"""
WITH b AS (SELECT transaction_id, CASE WHEN tie1 % 41 <> 0 THEN amount END AS amount,
                  CASE WHEN tie1 % 43 <> 0 THEN transaction_date END AS transaction_date FROM bronze)
SELECT COALESCE({REASON_SQL}, 'kept') AS outcome, COUNT(*) AS rows FROM b GROUP BY 1""")
def quarantine_bad_casts(t):
    """S13 over a landing with amounts and dates that don't cast: they are rejected with a reason, none is lost."""
    raw = FR.bronze_frame(t).select(*[F.col(c).cast("string").alias(c) for c in M.LANDING_COLUMNS])
    dirty = raw.withColumns({"amount": F.when(F.col("tie1") % 41 == 0, "N/A").otherwise(F.col("amount")),
                             "transaction_date": F.when(F.col("tie1") % 43 == 0, "soon").otherwise(F.col("transaction_date"))})
    kept, rejects = io.quarantine_split(M.typed(dirty))
    both = kept.select(F.lit("kept").alias("outcome")).unionAll(rejects.select("reject_reason"))
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))


# ---- pipelines (§2.15) ----

def _ctx(t):
    return M.RunContext.new(t.spark, RUN_ID, RUN_TS)


@query("ingest_bronze", "SELECT CAST(transaction_date AS VARCHAR) AS transaction_date, COUNT(*) AS rows FROM bronze GROUP BY 1")
def ingest_bronze(t):
    """L1: landing CSV -> Bronze Parquet partitioned by date, with provenance; rows per date."""
    ctx = _ctx(t)
    src = M.land_feed(t, ctx.path("landing"))
    b = M.ingest_bronze(ctx, src, ctx.path("bronze"))
    return b.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("rows"))


ENR_OUT = ("transaction_id, amount, status, merchant_id, customer_id, transaction_date, payment_method, "
           "merchant_name, category, city, quality_flag")


@query("transform_silver", f"SELECT {ENR_OUT} FROM enr")
def transform_silver(t):
    """L2: Bronze -> Silver (cast, gate, filter, dedup, enrich, flag), read back."""
    ctx = _ctx(t)
    src = M.land_feed(t, ctx.path("landing"))
    M.ingest_bronze(ctx, src, ctx.path("bronze"))
    s = M.transform_silver(ctx, ctx.path("bronze"), FR.merch_frame(t), ctx.path("silver"))
    return s.select(*[c.strip() for c in ENR_OUT.split(",")])


@query("run_gold", f"""
SELECT 'merchant_performance' AS table_name, CAST(merchant_id AS VARCHAR) || ' ' || CAST(transaction_date AS VARCHAR) AS key,
       {REV_SQL} AS revenue, COUNT(*) AS txns, {FAIL_SQL} AS rate_or_mean
FROM enr GROUP BY merchant_id, merchant_name, category, city, transaction_date
UNION ALL SELECT 'customer_ltv', CAST(customer_id AS VARCHAR), {REV_SQL}, COUNT(*), {round_sql('AVG(amount)', 2)}
FROM enr WHERE status = 'COMPLETED' GROUP BY customer_id
UNION ALL SELECT 'daily_summary', CAST(transaction_date AS VARCHAR), {REV_SQL}, COUNT(*), {FAIL_SQL} FROM enr GROUP BY transaction_date""")
def run_gold(t):
    """L3: Silver -> the three Gold tables; their rows as read back."""
    ctx = _ctx(t)
    src = M.land_feed(t, ctx.path("landing"))
    M.ingest_bronze(ctx, src, ctx.path("bronze"))
    M.transform_silver(ctx, ctx.path("bronze"), FR.merch_frame(t), ctx.path("silver"))
    paths = M.run_gold(ctx, ctx.path("silver"), ctx.path("gold"))
    day = F.col("report_date").cast("date").cast("string")
    columns = {"merchant_performance": (F.concat_ws(" ", F.col("merchant_id").cast("string"), day), "total_revenue", "txn_count", "failure_rate_pct"),
               "customer_ltv": (F.col("customer_id").cast("string"), "total_spent", "total_txns", "avg_txn_value"),
               "daily_summary": (day, "total_revenue", "total_txns", "failure_rate_pct")}
    out = None
    for name, (key, revenue, txns, rate) in columns.items():
        c = t.spark.read.parquet(paths[name]).select(F.lit(name).alias("table_name"), key.alias("key"), F.col(revenue).alias("revenue"),
                                                     F.col(txns).alias("txns"), F.col(rate).alias("rate_or_mean"))
        out = c if out is None else out.unionAll(c)
    return out


@query("run_medallion", f"""
SELECT '{RUN_ID}' AS run_id, 'SUCCESS' AS status, (SELECT COUNT(*) FROM bronze) AS input_rows,
       (SELECT COUNT(*) FROM bronze WHERE transaction_id IS NOT NULL AND amount >= 0) AS after_filter_rows,
       (SELECT COUNT(*) FROM enr) AS output_rows, 3 AS gold_tables""")
def run_medallion(t):
    """L4: the whole run (land, Bronze, Silver, Gold) with its metadata row."""
    meta = M.run_medallion(_ctx(t), t)
    return meta.select("run_id", "status", "input_rows", "after_filter_rows", "output_rows", "gold_tables")


DAYS = [RUN_DATE, dt.date(2001, 7, 16)]


@query("run_date_pipeline", f"""
WITH one AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_date, transaction_id ORDER BY ingestion_ts DESC, tie1, merchant_id,
                                          amount, tie2, tie3, tie4, return_flag) AS pick
             FROM bronze WHERE transaction_id IS NOT NULL AND amount >= 0
               AND transaction_date IN ({', '.join(f"DATE '{d}'" for d in DAYS)}))
SELECT o.transaction_id, CAST(o.amount AS DOUBLE) AS amount, o.status, o.merchant_id, o.transaction_date, m.merchant_name,
       CASE WHEN m.merchant_id IS NULL THEN 'UNMATCHED' ELSE 'CLEAN' END AS quality_flag
FROM one o LEFT JOIN merch m ON o.merchant_id = m.merchant_id WHERE o.pick = 1""")
def run_date_pipeline(t):
    """L1-L3 by run date: Bronze (transactions and merchants), Silver and Gold for one date, then for another, then
    the first again into the same tables: a run prunes to its date, replaces that and leaves the other alone. Returns Silver as
    it stands. A single day may be a few rows, so the gate is wide."""
    root = scratch_path(t.spark, "run_date")
    src, merchants = M.land_feed(t, f"{root}/landing"), M.land_merchants(t, f"{root}/landing_merchants")
    for day in [*DAYS, DAYS[0]]:
        ctx = M.RunContext.new(t.spark, RUN_ID, RUN_TS, run_date=day, gate_pct=100.0, root=root)
        M.ingest_bronze(ctx, src, ctx.path("bronze"))
        merch = M.ingest_merchants(ctx, merchants, ctx.path("bronze_merchants"))
        M.transform_silver(ctx, ctx.path("bronze"), merch, ctx.path("silver"))
        M.run_gold(ctx, ctx.path("silver"), ctx.path("gold"))
    return t.spark.read.parquet(f"{root}/silver").select(
        "transaction_id", F.col("amount").cast("double").alias("amount"), "status", "merchant_id",
        F.col("transaction_date").cast("date").alias("transaction_date"), "merchant_name", "quality_flag")


DIRTY_DAY_SQL = """SELECT *, CASE WHEN tie1 % 43 = 0 OR tie1 % 47 = 0 THEN 'undated' ELSE CAST(transaction_date AS VARCHAR) END AS run_date,
       CASE WHEN tie1 % 41 = 0 THEN NULL ELSE amount END AS amt FROM bronze"""
REJECT_SQL = """CASE WHEN transaction_id IS NULL THEN 'null_id' WHEN amt IS NULL THEN 'bad_amount' WHEN amt < 0 THEN 'negative_amount'
            WHEN run_date = 'undated' THEN 'bad_date' END"""


def land_dirty_feed(t, path):
    """The feed with what real landings have: amounts that are no numbers, dates that are none (``N/A``, null) and dates in another spelling."""
    b = FR.bronze_frame(t)
    short = F.date_format("transaction_date", "yyyy-M-d")
    day = (F.when(F.col("tie1") % 43 == 0, "N/A").when(F.col("tie1") % 47 == 0, F.lit(None)).when(F.col("tie1") % 5 == 0, short)
           .otherwise(F.col("transaction_date").cast("string")))
    rows = b.select(*[F.col(c).cast("string").alias(c) for c in M.LANDING_COLUMNS], day.alias("_day"))
    rows = rows.withColumns({"amount": F.when(F.col("tie1") % 41 == 0, "N/A").otherwise(F.col("amount")), "transaction_date": F.col("_day")})
    return io.write_csv(rows.drop("_day"), path)


def _run_days(t):
    """Two run dates and the first of them again over a dirty landing, all in one root; a day is a few rows, so the gate is wide."""
    root = scratch_path(t.spark, "accounted")
    src, merch = land_dirty_feed(t, f"{root}/landing"), FR.merch_frame(t)
    for day in [*DAYS, DAYS[0]]:
        ctx = M.RunContext.new(t.spark, RUN_ID, RUN_TS, run_date=day, gate_pct=100.0, root=root)
        M.ingest_bronze(ctx, src, ctx.path("bronze"))
        M.transform_silver(ctx, ctx.path("bronze"), merch, ctx.path("silver"))
    return ctx


@query("run_date_accounting", f"""
WITH d AS (SELECT *, {REJECT_SQL} AS reason FROM ({DIRTY_DAY_SQL}) x),
n AS (SELECT run_date, COUNT(*) AS landed, COUNT(reason) AS bad FROM d GROUP BY 1)
SELECT run_date, landed, CASE WHEN run_date IN ({', '.join(f"'{d}'" for d in DAYS)}) THEN landed WHEN run_date = 'undated' THEN 0 END AS ingested,
       CASE WHEN run_date IN ({', '.join(f"'{d}'" for d in DAYS)}) THEN landed - bad WHEN run_date = 'undated' THEN 0 END AS kept,
       CASE WHEN run_date IN ({', '.join(f"'{d}'" for d in DAYS)}, 'undated') THEN bad END AS rejected
FROM n""")
def run_date_accounting(t):
    """L1/L2/L4 by run date, after two dates and a re-run: every landed row stands under its date or under ``undated``;
    of the dates that ran, what landed was ingested, and kept or rejected."""
    out = M.accounting(_run_days(t))
    return out.select("run_date", F.col("landed").cast("bigint").alias("landed"), "ingested", "kept", "rejected")


@query("quarantine_by_run", f"""
SELECT run_date, reason AS reject_reason, COUNT(*) AS rows FROM (SELECT *, {REJECT_SQL} AS reason FROM ({DIRTY_DAY_SQL}) x) d
WHERE reason IS NOT NULL AND run_date IN ({', '.join(f"'{d}'" for d in DAYS)}, 'undated') GROUP BY 1, 2""")
def quarantine_by_run(t):
    """The quarantine after two dates and a re-run holds both dates' rejects once, and the undated rows."""
    return M.quarantine(_run_days(t)).groupBy("run_date", "reject_reason").agg(F.count(F.lit(1)).alias("rows"))


LTV_DAYS = [dt.date(2001, 7, 30), dt.date(1996, 1, 2), dt.date(2001, 7, 31)]


@query("customer_ltv_by_day", f"""
WITH f AS (SELECT * FROM silver WHERE status = 'COMPLETED' AND NOT (transaction_date = DATE '{LTV_DAYS[1]}' AND merchant_id % 2 = 0)),
m AS (SELECT customer_id, payment_method, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY COUNT(*) DESC, payment_method) AS rn FROM f GROUP BY 1, 2)
SELECT f.customer_id, CAST(SUM(amount) AS DOUBLE) AS total_spent, COUNT(*) AS total_txns, {round_sql('AVG(amount)', 2)} AS avg_txn_value,
       MIN(transaction_date) AS first_txn_date, MAX(transaction_date) AS last_txn_date, MIN(m.payment_method) AS preferred_payment_method
FROM f JOIN m ON f.customer_id = m.customer_id AND m.rn = 1 GROUP BY f.customer_id""")
def customer_ltv_by_day(t):
    """L3/A13 kept up to date: the history without its last two days, then these days one by one, the first of them with wrong rows and
    again with the right ones, and an old day whose even merchants are taken back. Equals a recompute of everything."""
    from ledgerlake.operators import incremental as INC
    done = materialize(FR.silver_frame(t).where(A.is_completed()).select("customer_id", "payment_method", "amount", "transaction_date", "merchant_id"), "completed")
    late, old, last = LTV_DAYS
    day = F.col("transaction_date")
    state = INC.ltv_state(t.spark, scratch_path(t.spark, "ltv_state"))
    state.apply(done.where(~day.isin(late, last)))
    state.apply(done.where(day == F.lit(late)).withColumn("amount", F.col("amount") * 2), [late])
    state.apply(done.where(day == F.lit(last)), [last])
    state.apply(done.where(day == F.lit(late)), [late])
    return INC.customer_ltv(state.apply(done.where((day == F.lit(old)) & (F.col("merchant_id") % 2 != 0)), [old]))


@query("stg_transactions", """
SELECT md5(concat_ws('-', COALESCE(transaction_id, '_null_'), COALESCE(CAST(merchant_id AS VARCHAR), '_null_'),
                          COALESCE(CAST(transaction_date AS VARCHAR), '_null_'))) AS transaction_sk,
       transaction_id, CAST(TRY_CAST(CAST(amount AS VARCHAR) AS DECIMAL(10,2)) AS DOUBLE) AS amount_usd, lower(status) AS status,
       CAST(merchant_id AS VARCHAR) AS merchant_id, CAST(customer_id AS VARCHAR) AS customer_id, transaction_date,
       trim(payment_method) AS payment_method
FROM bronze WHERE NOT starts_with(CAST(merchant_id AS VARCHAR), 'TEST_')""")
def stg_transactions(t):
    """The staging view over raw transactions."""
    s = M.stg_transactions(FR.bronze_frame(t))
    return s.withColumn("amount_usd", F.col("amount_usd").cast("double"))


CUTOFF = dt.date(2001, 1, 1)


@query("incremental_load", f"""
WITH s AS (SELECT * FROM bronze WHERE {VALID}),
b AS (SELECT DISTINCT transaction_id FROM s WHERE transaction_date <= DATE '{CUTOFF}'),
a AS (SELECT DISTINCT transaction_id FROM s WHERE transaction_date > DATE '{CUTOFF}')
SELECT 'initial' AS load, COUNT(*) AS rows FROM b
UNION ALL SELECT 'incremental', COUNT(*) FROM a WHERE transaction_id NOT IN (SELECT transaction_id FROM b)""")
def incremental_load(t):
    """Rows after the cutoff -> Silver rules -> insert-if-absent into the
    target that holds the rows up to the cutoff; rows loaded per load."""
    b = FR.bronze_frame(t)
    path = scratch_path(t.spark, "incremental_target")
    tagged = b.withColumn("load", F.when(F.col("transaction_date") <= F.lit(CUTOFF), "initial")
                          .otherwise("incremental"))
    target = M.incremental_load(t.spark, tagged, path, CUTOFF)
    return target.groupBy("load").agg(F.count(F.lit(1)).alias("rows"))


@query("fact_check_pack", f"""
WITH p AS (SELECT merchant_id, COALESCE(merchant_name, '') AS merchant_name, COALESCE(category, '') AS category,
                  {REV_SQL} AS rev, COUNT(*) AS n, {FAIL_SQL} AS rate FROM enr GROUP BY 1, 2, 3),
d AS (SELECT transaction_date AS day, {REV_SQL} AS rev, COUNT(*) AS n FROM enr GROUP BY 1)
SELECT 'revenue_trend' AS query_name, CAST(day AS VARCHAR) AS label, rev AS revenue, n AS txns, CAST(NULL AS DOUBLE) AS measure,
       CAST(NULL AS VARCHAR) AS note FROM d
UNION ALL SELECT 'top_merchants', merchant_name, rev, n, rate, NULL FROM p
UNION ALL SELECT 'failure_rate', merchant_name, NULL, n, rate, CAST(CAST(ROUND(n * rate / 100) AS BIGINT) AS VARCHAR) || ' failed' FROM p WHERE rate > 0
UNION ALL SELECT 'category_revenue', category, {round_sql('SUM(rev)', 2)}, CAST(SUM(n) AS BIGINT), {round_sql('AVG(rev)', 2)}, NULL FROM p GROUP BY category
UNION ALL SELECT 'sample_size_check', CAST(day AS VARCHAR), rev, n, NULL,
       CASE WHEN n <= 1 THEN 'SINGLE TRANSACTION' WHEN n <= 2 THEN 'TINY SAMPLE' ELSE 'ACCEPTABLE' END FROM d
UNION ALL SELECT 'day_merchant_anomaly', merchant_name, d.rev, d.n, p.rev, CAST(d.day AS VARCHAR)
FROM enr e JOIN d ON e.transaction_date = d.day JOIN (SELECT merchant_id, rev FROM p) p ON e.merchant_id = p.merchant_id
WHERE d.day = DATE '{RUN_DATE}'""".replace("day_merchant_anomaly', merchant_name", "day_merchant_anomaly', COALESCE(merchant_name, '')"))
def fact_check_pack(t):
    """The six evidence queries over one materialised enriched Silver; their rows, one under the other: label,
    revenue, transactions, a measure (failure rate, mean revenue per merchant, the merchant's total) and a note."""
    from ledgerlake.functions.scalars import round2
    from ledgerlake.session import materialize
    enr = materialize(FR.enr_frame(t), "enr")
    daily = materialize(A.daily_summary(enr), "daily")
    perf = materialize(A.merchant_performance_total(enr), "perf")
    none, day = F.lit(None), F.col("report_date").cast("string")

    def rows(name, df, label, revenue=none, txns=none, measure=none, note=none):
        return df.select(F.lit(name).alias("query_name"), label.alias("label"), revenue.cast("double").alias("revenue"),
                         txns.cast("bigint").alias("txns"), measure.cast("double").alias("measure"), note.cast("string").alias("note"))

    c = F.col
    failed = F.concat(F.round(c("txn_count") * c("failure_rate_pct") / 100).cast("bigint").cast("string"), F.lit(" failed"))
    size = (F.when(c("total_txns") <= 1, "SINGLE TRANSACTION").when(c("total_txns") <= 2, "TINY SAMPLE").otherwise("ACCEPTABLE"))
    category = perf.groupBy("category").agg(round2(F.sum("total_revenue")).alias("rev"), F.sum("txn_count").alias("n"),
                                            round2(F.avg("total_revenue")).alias("mean"))
    peak = (daily.where(c("report_date") == F.lit(RUN_DATE))
            .join(enr.select("transaction_date", "merchant_id").where(c("transaction_date") == F.lit(RUN_DATE)),
                  c("report_date") == c("transaction_date"))
            .join(perf.select("merchant_id", "merchant_name", c("total_revenue").alias("merchant_total")), "merchant_id"))
    parts = [rows("revenue_trend", daily, day, c("total_revenue"), c("total_txns")),
             rows("top_merchants", perf, c("merchant_name"), c("total_revenue"), c("txn_count"), c("failure_rate_pct")),
             rows("failure_rate", perf.where(c("failure_rate_pct") > 0), c("merchant_name"), none, c("txn_count"), c("failure_rate_pct"), failed),
             rows("category_revenue", category, c("category"), c("rev"), c("n"), c("mean")),
             rows("sample_size_check", daily, day, c("total_revenue"), c("total_txns"), none, size),
             rows("day_merchant_anomaly", peak, c("merchant_name"), c("total_revenue"), c("total_txns"), c("merchant_total"), day)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def _morning_sql():
    from ledgerlake.plans.queries.observability import ALERTS_SQL
    from ledgerlake.plans.catalog import REGISTRY
    drift_sql = REGISTRY["categorical_drift"].sql
    alerts_sql = "WITH " + ALERTS_SQL[len("WITH "):]
    base = """
WITH p AS (SELECT merchant_id, COUNT(*) AS n,
                  CAST(ROUND(CAST(100.0 * COUNT(*) FILTER (WHERE status = 'FAILED') / COUNT(*) AS DECIMAL(38,8)), 2) AS DOUBLE) AS rate,
                  CAST(COALESCE(SUM(CASE WHEN status = 'COMPLETED' THEN amount END), 0) AS DOUBLE) AS rev
           FROM enr GROUP BY merchant_id)
SELECT (SELECT COUNT(*) FROM enr) AS rows,
       (SELECT COUNT(*) FROM enr WHERE status = 'COMPLETED') AS completed,
       (SELECT COUNT(*) FROM enr WHERE status = 'FAILED') AS failed,
       (SELECT CAST(ROUND(CAST(AVG(amount) AS DECIMAL(38,8)), 2) AS DOUBLE) FROM enr) AS amount_mean,
       (SELECT COUNT(*) FROM p) AS merchants,
       (SELECT CAST(ROUND(CAST(SUM(rev) AS DECIMAL(38,8)), 2) AS DOUBLE) FROM p) AS total_revenue,
       (SELECT merchant_id FROM p ORDER BY rate DESC, merchant_id LIMIT 1) AS worst_merchant_id,
       (SELECT MAX(rate) FROM p) AS worst_failure_rate_pct,
       (SELECT MAX(drifted_columns) FROM (__DRIFT__) d) AS drifted_columns,
       (SELECT COUNT(*) FROM (__ALERTS__) a) AS alerts_fired"""
    return base.replace("__DRIFT__", drift_sql).replace("__ALERTS__", alerts_sql)


@query("morning_report_data", _morning_sql())
def morning_report_data(t):
    """The numbers of the daily health report: layer profile (DQ15),
    categorical drift (DQ16), merchant health (A19) and fired alerts (O5),
    each one aggregate, combined as scalar subqueries. All of them read Bronze and enriched Silver as written
    once from one pass over the line items."""
    from ledgerlake.functions.scalars import round2
    from ledgerlake.operators import quality as Q
    from ledgerlake.operators import slo as O
    from ledgerlake.plans.queries.observability import layers, measures
    from ledgerlake.plans.queries.quality import DRIFT_COLS
    from ledgerlake.session import materialize
    bronze, e = layers(t)
    prof = e.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("status") == "COMPLETED").cast("bigint").alias("completed"),
                 F.count_if(F.col("status") == "FAILED").cast("bigint").alias("failed"),
                 round2(F.avg("amount")).alias("amount_mean"))
    p = materialize(A.merchant_performance_total(e), "perf")
    health = p.agg(F.count(F.lit(1)).alias("merchants"), round2(F.sum("total_revenue")).alias("total_revenue"),
                   F.min_by("merchant_id", F.struct(-F.col("failure_rate_pct"), F.col("merchant_id"))).alias("w"),
                   F.max("failure_rate_pct").alias("m"))
    drift = Q.categorical_drift(bronze, e, DRIFT_COLS).agg(F.max("drifted_columns"))
    alerts = O.evaluate_alerts(measures(t, bronze, e)).agg(F.count(F.lit(1)))
    return prof.select("rows", "completed", "failed", "amount_mean",
                       health.select("merchants").scalar().alias("merchants"),
                       health.select("total_revenue").scalar().alias("total_revenue"),
                       health.select("w").scalar().alias("worst_merchant_id"),
                       health.select("m").scalar().alias("worst_failure_rate_pct"),
                       drift.scalar().alias("drifted_columns"), alerts.scalar().alias("alerts_fired"))

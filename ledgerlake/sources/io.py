"""Scans, sources and sinks.

Every writer targets the shared folder named by ``spark.checkpoint.dir``
(see :func:`ledgerlake.session.scratch_path`), never a machine-local temp
dir, and every sink returns a frame read back from what it wrote.
"""

from __future__ import annotations

import datetime as dt
import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

log = logging.getLogger("ledgerlake.io")

#: Compression of partitioned tables, which are written once and kept.
STORED = "zstd"


def all_string_schema(columns: list[str]) -> StructType:
    """The Bronze contract — every column a string, nothing inferred."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def write_csv(df: DataFrame, path: str, compression: str = "none") -> str:
    """Write a frame as header CSV (the raw landing format)."""
    df.write.mode("overwrite").option("header", True).option("compression", compression).csv(path)
    return path


def csv_header(spark: SparkSession, path: str) -> list[str] | None:
    """The column names that a header CSV itself has; None if there is no such source."""
    try:
        return spark.read.option("header", True).csv(path).columns
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def csv_bronze_scan(spark: SparkSession, path: str | list[str], columns: list[str]) -> DataFrame:
    """Header CSV read with an explicit all-string schema (no inference pass)."""
    return spark.read.schema(all_string_schema(columns)).option("header", True).csv(path)


def with_provenance(df: DataFrame, run_id: str, run_ts: dt.datetime) -> DataFrame:
    """Ingestion timestamp (the run's), source file name, run id."""
    return (df.withColumn("ingestion_timestamp", F.lit(run_ts).cast("timestamp_ntz"))
              .withColumn("source_file", F.col("_metadata.file_name"))
              .withColumn("pipeline_run_id", F.lit(run_id)))


def write_partitioned(df: DataFrame, path: str, partition_col: str, mode: str = "overwrite") -> str:
    """Parquet partitioned by a date column.

    ``rebalance`` on the partition column lets AQE split a hot date into
    several files and merge small ones, so one date holding a third of the
    rows is not written by a single task; rows travel there packed
    (:func:`rebalance_packed`). Overwrite is *dynamic*: only the
    partitions present in ``df`` are replaced (X2).
    """
    from ledgerlake.session import sql_conf
    # Writers = shuffle partitions: AQE must not coalesce a small table with
    # thousands of dates into one task writing every date's file in turn.
    # (Splitting skewed partitions of the rebalance is a separate AQE rule
    # and stays on.)
    with sql_conf(df.sparkSession, spark__sql__adaptive__coalescePartitions__enabled="false",
                  spark__sql__adaptive__advisoryPartitionSizeInBytes=PACKED_TASK):
        (rebalance_packed(df, partition_col)
           .write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", STORED)
           .partitionBy(partition_col).parquet(path))
    return path


#: Arrow bytes of rows that a task packs at a time, and packed bytes that a writing task should have: they hold about four times
#: the rows that as many bytes of a plain shuffle hold.
PACK_BYTES, PACKED_TASK = 64 << 20, 16 << 20


def rebalance_packed(df: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` dealt by ``key`` as the hint ``rebalance`` deals them, in compressed blocks of columns: about a fourth of
    the bytes that as many wide rows take in a shuffle.

    A block is what a task has for one shuffle partition, by the hash that the shuffle itself uses, so all rows of a key are
    still dealt to one partition, and AQE still splits one that is too large, between blocks. A task holds PACK_BYTES of rows.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names, at = df.columns, df.columns.index(key)
    packed = StructType([StructField(key, df.schema[key].dataType, True), StructField("_block", BinaryType(), True)])

    def pack(batches):  # nested, as unpack, so that the executors get their code with the task
        import numpy as np
        import pyarrow as pa
        import pyarrow.parquet as pq

        def blocks(held):
            rows = pa.Table.from_batches(held)
            hashes = rows.column(len(names)).to_numpy()
            rows = rows.select(range(len(names))).rename_columns([str(i) for i in range(len(names))])  # columns go by their place
            slots = np.mod(hashes, parts)
            order = np.lexsort((hashes, slots))  # rows of a key stand together
            rows, slots = rows.combine_chunks().take(pa.array(order)), slots[order]
            ends = [*(np.flatnonzero(np.diff(slots)) + 1).tolist(), len(slots)]
            for start, end in zip([0, *ends], ends):
                sink = pa.BufferOutputStream()
                pq.write_table(rows.slice(start, end - start), sink, compression=STORED, use_dictionary=False, write_statistics=False)
                first = rows.column(at).slice(start, 1).combine_chunks()
                yield pa.RecordBatch.from_arrays([first, pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=[key, "_block"])

        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= PACK_BYTES:
                yield from blocks(held)
                held, size = [], 0
        if held:
            yield from blocks(held)

    def unpack(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            for block in batch.column(1):
                rows = pq.ParquetFile(pa.BufferReader(block.as_buffer())).read(use_threads=False)
                yield from rows.rename_columns(names).to_batches(max_chunksize=10000)

    hashed = df.select("*", F.hash(key).alias("_hash"))
    return hashed.mapInArrow(pack, packed).hint("rebalance", parts, key).mapInArrow(unpack, df.schema)


def observed(observation: Observation, name: str) -> int:
    """A count that was observed on a write; 0 where Spark dropped the observed part of a plan as it has no rows."""
    try:
        return int(observation.get[name])
    except Py4JJavaError as e:
        if "AssertionError" not in e.java_exception.getClass().getName():
            raise
        return 0


def replace_partition(df: DataFrame, path: str, partition_col: str, value) -> str:
    """S5 for one partition: its folder is replaced as a whole, also by no rows, which a dynamic overwrite would leave alone."""
    df.drop(partition_col).write.mode("overwrite").option("compression", STORED).parquet(f"{path}/{partition_col}={value}")
    return path


def read_partition(spark: SparkSession, path: str, partition_col: str, value) -> DataFrame:
    """Read one partition; the predicate becomes a ``PartitionFilters`` entry."""
    return spark.read.parquet(path).where(F.col(partition_col) == F.lit(value))


def optional_source_scan(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv",
                         **options) -> DataFrame:
    """A missing source logs a warning and yields an empty typed frame
    (the day is skipped, the job does not crash)."""
    try:
        reader = spark.read.schema(schema).options(**options)
        df = reader.format(fmt).load(path)
        df.limit(0).collect()  # resolve the path now (cheap: no rows)
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        log.warning("source %s missing: skipping", path)
        return spark.createDataFrame([], schema)


def is_missing(spark: SparkSession, path: str) -> bool:
    """Whether there is no folder at ``path``; one that an unfinished run left is there."""
    try:
        spark.read.schema("none string").parquet(path)
        return False
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return True


RUN_META_DDL = ("run_id STRING, status STRING, error_message STRING, run_date STRING, input_rows BIGINT, "
                "after_filter_rows BIGINT, output_rows BIGINT, gold_tables INT, started_at STRING, "
                "completed_at STRING")


def run_metadata_sink(spark: SparkSession, path: str, meta: dict) -> DataFrame:
    """One JSON row per run, appended by Spark to the shared folder and
    read back under the declared schema (null fields stay null)."""
    schema = StructType.fromDDL(RUN_META_DDL)
    df = spark.createDataFrame([tuple(meta.get(f.name) for f in schema.fields)], schema)
    df.coalesce(1).write.mode("append").json(path)
    return spark.read.schema(schema).json(path)


def partner_feed(enr: DataFrame, path: str, partners: int = 3) -> DataFrame:
    """One output folder per partner (merchant_id mod n) with the
    customer id replaced by its SHA-256."""
    out = enr.select(
        (F.col("merchant_id") % partners).cast("int").alias("partner_id"), "transaction_id", "merchant_id",
        F.sha2(F.col("customer_id").cast("string"), 256).alias("customer_hash"), "amount", "transaction_date")
    out.hint("rebalance", "partner_id").write.mode("overwrite").partitionBy("partner_id").parquet(path)
    return enr.sparkSession.read.parquet(path)


def insert_if_absent(batch: DataFrame, target_path: str, key: str, order) -> DataFrame:
    """INSERT OR IGNORE — the batch is de-duplicated (first row per key by ``order``) and the rows whose key the
    target does not hold are added to it (:class:`ledgerlake.sources.keyed.KeyedTable`: only files that may hold a key of the
    batch are read). Returns the rows inserted, read back."""
    from ledgerlake.sources.keyed import KeyedTable
    table = KeyedTable(batch.sparkSession, target_path, key)
    table.insert_absent(batch, order)
    return table.last()


def key_conflicts(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Keys that would violate the primary key — duplicated within the batch, or already in the target. Both come
    from one grouping of the two sides' keys, counted before the shuffle, so each side is read once."""
    b = batch.where(F.col(key).isNotNull()).select(key, F.lit(1).alias("_batch"), F.lit(0).alias("_target"))
    t = target.where(F.col(key).isNotNull()).select(key, F.lit(0).alias("_batch"), F.lit(1).alias("_target"))
    n = F.col("n")

    def conflict(cond, reason):
        return F.when(cond, F.struct(F.lit(reason).alias("reason"), n.alias("occurrences")))

    per = b.unionByName(t).groupBy(key).agg(F.sum("_batch").alias("n"), F.max("_target").alias("held")).where("n > 0")
    found = F.array_compact(F.array(conflict(n > 1, "duplicate_in_batch"), conflict(F.col("held") == 1, "exists_in_target")))
    return per.select(key, F.inline(found))


def quarantine_split(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One pass labels each row with a reject reason; kept rows and
    rejects are two filters of the same labelled frame (kept + rejects = input)."""
    reason = (F.when(F.col("transaction_id").isNull(), "null_id")
               .when(F.col("amount").isNull(), "bad_amount")
               .when(F.col("amount") < 0, "negative_amount")
               .when(F.col("transaction_date").isNull(), "bad_date"))
    labelled = bronze.withColumn("reject_reason", reason)
    return (labelled.where(F.col("reject_reason").isNull()).drop("reject_reason"),
            labelled.where(F.col("reject_reason").isNotNull()))


def load_json_table(spark: SparkSession, source: DataFrame, path: str, ddl: str) -> DataFrame:
    """Rows landed as JSON lines, loaded into a table with a declared schema."""
    source.write.mode("overwrite").json(path)
    return spark.read.schema(StructType.fromDDL(ddl)).json(path)

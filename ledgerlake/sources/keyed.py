"""A target table with a primary key, whose inserts read what the batch may meet and not the whole table.

    data/_load=N/_bucket=B/    the rows of load N whose key hashes to bucket B
    filters/_load=N/_bucket=B/ a Bloom filter of those keys, one row per block of 256 bits
    sizes/_load=N/             keys and blocks of each bucket's filter
    ledger/                    one row per committed load

A batch's keys are looked up in the filters of their buckets by a join on (load, bucket, block); only the buckets of
loads in which some key may stand are read, key column only, and compared exactly, so a false positive costs a read and
no row. A load counts once its ledger row is written: what a run leaves behind that dies before is
overwritten by the next, and a batch whose (writer, epoch) is in the ledger is not inserted again.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.session import materialize

#: Buckets of a new table, bits of a filter per key (about 1 % false positives), and 64-bit words of a block.
BUCKETS, BITS_PER_KEY, WORDS = 32, 12, 4


class Ledger:
    """Committed entries: each is one JSON row in a file of its own, written by Spark, so it is there or it is not."""

    def __init__(self, spark: SparkSession, path: str, ddl: str):
        self.spark, self.path, self.schema = spark, path, StructType.fromDDL(ddl)

    def rows(self) -> list[Row]:
        try:
            return self.spark.read.schema(self.schema).json(self.path).collect()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":  # any other error is raised: an unreadable ledger is not an empty one
                return []
            raise

    def commit(self, **values) -> None:
        row = tuple(values.get(n) for n in self.schema.names)
        self.spark.createDataFrame([row], self.schema).coalesce(1).write.mode("append").json(self.path)


@dataclass(frozen=True)
class Load:
    """What a load did: ``candidates`` of the table's ``partitions`` (buckets of loads) were read for its keys."""

    number: int
    rows: int
    candidates: int
    partitions: int
    repeated: bool = False


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _bits(key: Column) -> dict[str, Column]:
    """Where a key stands in a filter: ``at`` chooses the block, the words have two bits each."""
    m = F.xxhash64(key, F.lit(2))

    def one(shift: int) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(m, shift).bitwiseAND(F.lit(63)).cast("int"))

    return {"at": F.xxhash64(key, F.lit(1))} | {f"w{i}": one(12 * i).bitwiseOR(one(12 * i + 6)) for i in range(WORDS)}


class KeyedTable:
    """Insert-if-absent by ``key`` into the table at ``path``. Null keys are never inserted."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key = spark, path, key
        self.ledger = Ledger(spark, f"{path}/ledger", "load int, writer string, epoch bigint, key string, buckets int, rows bigint, "
                                                      "candidates bigint, partitions bigint, replaced array<int>, columns string")
        first = min(self.ledger.rows(), key=lambda r: r["load"], default=None)
        if first is not None and first["key"] != key:
            raise ValueError(f"{path} is keyed by {first['key']}, not {key}")
        self.buckets = first["buckets"] if first is not None else buckets

    def loads(self) -> list[Row]:
        """The committed loads that no compaction has replaced."""
        rows = self.ledger.rows()
        gone = {n for r in rows for n in r["replaced"] or []}
        return sorted((r for r in rows if r["load"] not in gone), key=lambda r: r["load"])

    def _stored(self, part: str, folders: list[str]) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.path}/{part}").parquet(*[f"{self.path}/{part}/{f}" for f in folders])

    def read(self) -> DataFrame:
        """The table's rows."""
        loads = self.loads()
        if not loads:
            raise FileNotFoundError(f"no committed load in {self.path}")
        full = [f"_load={r['load']}" for r in loads if r["rows"]]
        if not full:
            return self.spark.createDataFrame([], StructType.fromJson(json.loads(loads[0]["columns"])))
        return self._stored("data", full).drop("_load", "_bucket")

    def may_hold(self, keys: DataFrame) -> DataFrame:
        """(key, _load, _bucket) where the filters do not rule the key out. ``keys``: the key column, without repeats."""
        full = [f"_load={r['load']}" for r in self.loads() if r["rows"]]
        if not full:
            return keys.select(F.col(self.key), F.lit(0).alias("_load"), F.lit(0).alias("_bucket")).limit(0)
        asked = keys.select(F.col(self.key), _bucket(F.col(self.key), self.buckets).alias("_bucket")).withColumns(_bits(F.col(self.key)))
        asked = asked.join(self._stored("sizes", full).select("_load", "_bucket", "blocks"), "_bucket").withColumn("block", F.pmod("at", "blocks"))
        stored = self._stored("filters", full).select("_load", "_bucket", "block", *[F.col(f"w{i}").alias(f"f{i}") for i in range(WORDS)])
        inside = F.lit(True)
        for i in range(WORDS):
            inside = inside & (F.col(f"f{i}").bitwiseAND(F.col(f"w{i}")) == F.col(f"w{i}"))
        return asked.join(stored, ["_load", "_bucket", "block"]).where(inside).select(self.key, "_load", "_bucket")

    def present(self, keys: DataFrame) -> tuple[DataFrame, int]:
        """The keys that the table holds, and how many of its partitions were read to tell."""
        hits = materialize(self.may_hold(keys), "key_hits")
        places = sorted((r["_load"], r["_bucket"]) for r in hits.select("_load", "_bucket").distinct().collect())  # at most the table's partitions
        if not places:
            return hits.select(self.key).limit(0), 0
        stored = self._stored("data", [f"_load={n}/_bucket={b}" for n, b in places]).select(F.col(self.key), "_load", "_bucket")
        return hits.join(stored, [self.key, "_load", "_bucket"], "left_semi").select(self.key), len(places)

    def partitions(self) -> int:
        full = [f"_load={r['load']}" for r in self.loads() if r["rows"]]
        return self._stored("sizes", full).count() if full else 0

    def insert_absent(self, batch: DataFrame, order, writer: str | None = None, epoch: int | None = None) -> Load:
        """INSERT OR IGNORE: the first row per key by ``order`` of those whose key the table does not hold. A batch of a known
        (writer, epoch) is the replay of a committed one and changes nothing."""
        from ledgerlake.operators.windows import first_per_key
        rows = self.ledger.rows()
        for r in rows:
            if epoch is not None and (r["writer"], r["epoch"]) == (writer, epoch):
                return Load(r["load"], r["rows"], r["candidates"], r["partitions"], repeated=True)
        number = max((r["load"] for r in rows), default=-1) + 1
        keyed = batch.where(F.col(self.key).isNotNull())
        partitions, read = self.partitions(), 0
        if partitions:
            keyed = materialize(keyed, "keyed_batch")
            there, read = self.present(keyed.select(self.key).distinct())
            # A key that is there comes first among its rows, so one window drops repeats and known keys.
            both = keyed.withColumn("_there", F.lit(False)).unionByName(there.withColumn("_there", F.lit(True)), allowMissingColumns=True)
            new = first_per_key(both, self.key, [F.col("_there").desc(), *order]).where(~F.col("_there")).drop("_there")
        else:
            new = first_per_key(keyed, self.key, order)
        new = new.withColumn("_bucket", _bucket(F.col(self.key), self.buckets))
        inserted = self._write(number, new)
        self.ledger.commit(load=number, writer=writer, epoch=epoch, key=self.key, buckets=self.buckets, rows=inserted, candidates=read,
                           partitions=partitions, replaced=[], columns=keyed.schema.json())
        return Load(number, inserted, read, partitions)

    def _write(self, number: int, rows: DataFrame) -> int:
        """Data, filters and sizes of a load; whatever an earlier attempt at it left is replaced."""
        out = rows.hint("rebalance", "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "static")
        out.partitionBy("_bucket").parquet(f"{self.path}/data/_load={number}")
        n = self.spark.read.schema(rows.schema).parquet(f"{self.path}/data/_load={number}").count()  # from the files' footers
        if not n:
            return 0
        keys = self._stored("data", [f"_load={number}"]).select("_bucket", F.col(self.key)).withColumns(_bits(F.col(self.key))).drop(self.key)
        sizes = keys.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("blocks", F.ceil(F.col("n") * BITS_PER_KEY / (64 * WORDS)).cast("bigint"))
        sizes.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/sizes/_load={number}")
        sizes = self._stored("sizes", [f"_load={number}"]).select("_bucket", "blocks")
        placed = keys.join(sizes, "_bucket").withColumn("block", F.pmod("at", "blocks"))
        filters = placed.groupBy("_bucket", "block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
        filters.hint("rebalance", "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_bucket").parquet(
            f"{self.path}/filters/_load={number}")
        return n

    def last(self) -> DataFrame:
        """The rows of the latest load, read back."""
        load = self.loads()[-1]
        if not load["rows"]:
            return self.spark.createDataFrame([], StructType.fromJson(json.loads(load["columns"])))
        return self._stored("data", [f"_load={load['load']}"]).drop("_load", "_bucket")

    def compact(self) -> Load:
        """Rewrites all loads as one, so that a key is looked up in one filter. The old files stay for running readers."""
        loads = self.loads()
        number = max(r["load"] for r in self.ledger.rows()) + 1
        rows = self._write(number, self.read().withColumn("_bucket", _bucket(F.col(self.key), self.buckets)))
        self.ledger.commit(load=number, key=self.key, buckets=self.buckets, rows=rows, candidates=0, partitions=0,
                           replaced=[r["load"] for r in loads], columns=loads[0]["columns"])
        return Load(number, rows, 0, 0)

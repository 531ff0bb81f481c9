"""Tables stored by buckets of their join key, so that two of them join without a shuffle.

Rows are dealt once, when they are written: bucket i of every table with the same number of buckets holds the same keys, and a
join of two such tables reads bucket i of both in one task. Nothing can split such a task, so a key with more rows than a
bucket should hold is kept apart in an unbucketed table of its own; its rows are joined by an ordinary join, which
Spark broadcasts or splits by size. At most HOT times the buckets many keys can be that frequent.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A key is kept apart if it has more rows than this part of an average bucket.
HOT = 0.5


@dataclass(frozen=True)
class Bucketed:
    """A table at ``path``: ``cold/`` by buckets of ``key`` and, if ``hot``, ``hot/`` with the rows of the frequent keys."""

    path: str
    key: str
    buckets: int
    columns: str
    hot: bool
    rows: int

    @staticmethod
    def open(spark: SparkSession, path: str) -> "Bucketed":
        return Bucketed(**json.loads(spark.read.text(f"{path}/about").collect()[0][0]))

    def cold(self, spark: SparkSession) -> DataFrame:
        """The bucketed rows. A session's catalog must know the buckets, so the table gets a name there."""
        name = f"bucketed_{uuid.uuid4().hex[:12]}"
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(self.columns)).fields)
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{self.path}/cold'")
        return spark.table(name)

    def frequent(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(StructType.fromJson(json.loads(self.columns))).parquet(f"{self.path}/hot")

    def read(self, spark: SparkSession) -> DataFrame:
        cold = self.cold(spark)
        return cold.unionByName(self.frequent(spark)) if self.hot else cold


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> Bucketed:
    """Writes ``df`` to ``path`` in ``buckets`` buckets of ``key``, one sorted file each; frequent keys apart."""
    spark = df.sparkSession
    counts = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("n"))  # combined before the shuffle
    rows = df.count()
    frequent = counts.where(F.col("n") > max(1.0, HOT * rows / buckets)).select("_k")
    is_hot = F.col(key).eqNullSafe(F.col("_k"))
    # Fewer than buckets / HOT keys can be that frequent, so the side is bounded whatever the table's size.
    hot = df.join(F.broadcast(frequent), is_hot, "left_semi")
    hot.write.mode("overwrite").parquet(f"{path}/hot")
    some = not spark.read.schema(df.schema).parquet(f"{path}/hot").isEmpty()
    name = f"bucketing_{uuid.uuid4().hex[:12]}"
    cold = df.join(F.broadcast(frequent), is_hot, "left_anti") if some else df
    (cold.repartition(buckets, F.col(key)).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
         .option("path", f"{path}/cold").format("parquet").saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table has a path of its own
    about = Bucketed(path, key, buckets, df.schema.json(), some, rows)
    spark.createDataFrame([(json.dumps(asdict(about)),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
    return about


def join_bucketed(left: Bucketed, right: Bucketed, spark: SparkSession) -> DataFrame:
    """Inner join on the key. Bucketed rows of both sides meet without a shuffle, frequent keys of either by an ordinary join."""
    if left.buckets != right.buckets:
        raise ValueError(f"{left.buckets} and {right.buckets} buckets do not meet")

    def joined(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.withColumnRenamed(right.key, "_right_key")
        return a.join(b, F.col(left.key) == F.col("_right_key")).drop("_right_key")

    out = joined(left.cold(spark), right.cold(spark))
    if left.hot:
        out = out.unionByName(joined(left.frequent(spark), right.read(spark)))
    if right.hot:
        out = out.unionByName(joined(left.cold(spark), right.frequent(spark)))
    return out

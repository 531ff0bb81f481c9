"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import materialize

__all__ = ["fold_out", "join_key", "key_columns", "kinds_text", "load", "map_arrow", "materialize", "pick", "ship", "to_blocks"]


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly these columns, found by their exact name. Columns that differ only in
    case, or that clash with names an operator uses inside, are left behind."""
    slots = [f"_slot{i}" for i in range(len(df.columns))]
    at = {n: slots[df.columns.index(n)] for n in names}
    return df.toDF(*slots).select(*[F.col(at[n]).alias(n) for n in names])


def key_columns(df: DataFrame) -> DataFrame:
    """(doc_id, rid, text) with null texts as empty ones. ``rid`` is a hash of the text:
    rows that share doc_id but not text stay apart, repeated rows share a key."""
    text = F.coalesce("text", F.lit(""))
    return pick(df, "doc_id", "text").select("doc_id", F.xxhash64(text).alias("rid"), text.alias("text"))


def join_key(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on (doc_id, rid); null ids match each other. The keys of ``left`` stay."""
    right = right.withColumnsRenamed({"doc_id": "_doc", "rid": "_rid"})
    out = left.join(right, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("rid") == F.col("_rid")), how)
    return out.drop("_doc", "_rid")


def fold_out(doc_id: str = "doc_id") -> Column:
    """True for the rows that models must not learn from: crc32(doc_id as text) mod 4 is 2
    (a null id counts as not held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def kinds_text(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` joined by commas, by start, then by the place of the kind in
    ``kinds``. ``spans``: array of struct(s int, k int, e int)."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat(
        F.element_at(names, x["k"] + 1), F.lit(":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))), ",")


def to_blocks(total_bytes: int, bound: int) -> int:
    """Number of blocks of at most about ``bound`` bytes each."""
    return max(1, -(-int(total_bytes) // bound))


_SHIPPED: set[str] = set()


#: Rows handed to a Python worker at once; a batch of long texts is held by the JVM and the worker both.
ROWS_IN = 2048


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application, and keep the workers' batches small."""
    context = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ROWS_IN:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_IN))
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerlake-code-"), "ledgerlake_code.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(package)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def map_arrow(df: DataFrame, task: Callable, schema) -> DataFrame:
    """``df.mapInArrow(task, schema)`` with this package's code on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(task, schema)

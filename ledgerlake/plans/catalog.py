"""Registry of named queries: each key has a Spark callable and, where the
operator is expressible in SQL, the oracle SQL that checks it.

Query modules register with ``@query(key, sql)``; the callable receives a
:class:`Tables` handle and returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.plans.oracle import with_frames
from ledgerlake.session import fine_partitions
from ledgerlake.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    doc: str

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        fine_partitions(spark)
        return self.build(Tables(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def query(key: str, sql: str | None = None, frames: bool = True):
    """Register ``fn(tables) -> DataFrame`` under ``key``.

    ``sql`` is the oracle query; with ``frames`` it may refer to the frame
    names ``ord bronze merch silver enr``.
    """

    def deco(fn: Callable[[Tables], DataFrame]):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        oracle = None
        if sql is not None:
            oracle = with_frames(sql) if frames else sql
        REGISTRY[key] = Query(key, fn, oracle, (fn.__doc__ or "").strip())
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every query module so their registrations run."""
    from ledgerlake.plans import queries  # noqa: F401

    return REGISTRY

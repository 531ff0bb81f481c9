"""Spark session settings shared by jobs, tests and the benchmark.

The settings are the ones a production job would carry: UTC session clock,
ANSI on (bad casts surface, and we use ``try_cast`` where input is dirty),
AQE with partition coalescing and skew-join splitting, and dynamic
partition overwrite so a re-run replaces only the partitions it writes.
"""

from __future__ import annotations

import contextlib
import functools
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ledgerlake", extra_conf: dict | None = None) -> SparkSession:
    """Return a session with the engine's settings.

    On a cluster ``master`` is left to spark-submit; locally pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("LEDGERLAKE_DRIVER_MEM", "8g"))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conf(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (e.g. the driver's)."""
    for k, v in SESSION_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    # Listing a table with thousands of date partitions: one listing task per
    # directory (the default) costs more than the listing; bound the tasks to
    # the cluster's parallelism.
    par = max(64, spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(min(par, 10000)))


#: Partitions that a shuffle starts with; AQE joins them again up to its advisory size (64 MB). Beyond 200 a map task would hold its rows to sort them by partition.
FINE_PARTITIONS = 200


def fine_partitions(spark: SparkSession) -> None:
    """Deal shuffles out finely and let AQE choose the tasks, so that a task's share of the rows, and with it the memory of its
    sorts and hash tables, is bounded by the advisory size and does not grow with the input over a fixed number of partitions."""
    n = max(FINE_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only on a local master (tests, a laptop) do we pick a scratch folder ourselves where the
    setting is absent, and record it in the session, so every later job reuses it. On a cluster a
    machine-local folder would be another one on each machine, so its absence is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint area for tables a job writes.

    Every call gets its own folder, so concurrent runs never share files.
    """
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerlake/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def sql_conf(spark: SparkSession, **conf):
    """Temporarily set SQL confs (dots written as ``__``) around an action."""
    keys = {k.replace("__", "."): str(v) for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def releases_shuffles(stage):
    """A stage (its first argument has the ``spark`` session) whose jobs each delete their shuffle files when they end. By default
    they stay until the driver collects garbage, which a long run may never need, so the disks would hold those of all its jobs."""
    @functools.wraps(stage)
    def run(owner, *args, **kwargs):
        with sql_conf(owner.spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
            return stage(owner, *args, **kwargs)

    return run


def materialize(df, name: str = "materialized"):
    """Compute a frame once and cut its lineage: written as Parquet to a fresh
    folder under the shared ``spark.checkpoint.dir`` and read back (survives
    executor loss; never a machine-local checkpoint; later branches read only
    the columns they need). Used when one query reads a costly frame in
    several branches that Spark cannot reuse (their column pruning differs)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)

"""The pipeline's stages on dirty landings, and what must not be taken for an empty target."""

import dataclasses
import datetime as dt
import pathlib
import time
import types

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import frames as FR
from ledgerlake.plans import medallion as M
from ledgerlake.session import checkpoint_dir
from ledgerlake.sources import io
from ledgerlake.sources.keyed import KeyedTable
from ledgerlake.sources.tables import Tables

from .conftest import SF_SMALL


def _landing(spark, ctx, bad_every):
    """One day of the feed, its dates made equal, with amounts that don't cast in every ``bad_every``-th row."""
    t = Tables(spark, SF_SMALL)
    feed = FR.bronze_frame(t).where(F.col("transaction_id").isNotNull() & (F.col("amount") >= 0)).limit(400)
    text = feed.select(*[F.col(c).cast("string").alias(c) for c in M.LANDING_COLUMNS])
    n = F.crc32(F.col("transaction_id").cast("binary")) % bad_every
    dirty = text.withColumns({"transaction_date": F.lit("2001-07-15"), "amount": F.when(n == 0, "N/A").otherwise(F.col("amount"))})
    return io.write_csv(dirty.coalesce(1), ctx.path("landing")), FR.merch_frame(t)


def test_cast_failures_halt_above_the_gate(spark):
    ctx = M.RunContext.new(spark)
    src, merch = _landing(spark, ctx, 2)
    M.ingest_bronze(ctx, src, ctx.path("bronze"))
    with pytest.raises(RuntimeError, match="quality gate"):
        M.transform_silver(ctx, ctx.path("bronze"), merch, ctx.path("silver"))


def test_cast_failures_below_the_gate_are_quarantined(spark):
    ctx = M.RunContext.new(spark)
    src, merch = _landing(spark, ctx, 50)
    M.ingest_bronze(ctx, src, ctx.path("bronze"))
    M.transform_silver(ctx, ctx.path("bronze"), merch, ctx.path("silver"))
    rejects = M.quarantine(ctx)
    assert {r[0] for r in rejects.select("reject_reason").distinct().collect()} == {"bad_amount"}
    assert ctx.counts["rejected"] == rejects.count() > 0
    assert ctx.counts["input"] == ctx.counts["after_filter"] + ctx.counts["rejected"]


def test_a_source_without_a_required_column_is_refused(spark):
    ctx = M.RunContext.new(spark)
    path = io.write_csv(spark.createDataFrame([("1",)], "transaction_id string"), ctx.path("landing"))
    with pytest.raises(ValueError, match="missing required columns: amount"):
        M.ingest_bronze(ctx, path, ctx.path("bronze"))


def test_only_a_missing_path_means_an_empty_ledger(spark, tmp_path):
    assert KeyedTable(spark, str(tmp_path / "none"), "id").loads() == []
    with pytest.raises(Exception):
        KeyedTable(spark, "nosuchfs://host/table", "id")


def test_a_cluster_needs_a_shared_folder():
    conf = types.SimpleNamespace(get=lambda *_: None, set=lambda *_: None)
    context = types.SimpleNamespace(master="spark://host:7077", getConf=lambda: conf)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(types.SimpleNamespace(conf=conf, sparkContext=context))


def _run(spark, root, src, day, gate=100.0):
    ctx = M.RunContext.new(spark, run_date=day, root=root, gate_pct=gate)
    M.ingest_bronze(ctx, src, ctx.path("bronze"))
    M.transform_silver(ctx, ctx.path("bronze"), FR.merch_frame(Tables(spark, SF_SMALL)), ctx.path("silver"))
    M.run_gold(ctx, ctx.path("silver"), ctx.path("gold"))
    return ctx


def _feed(spark, rows, path, mode="overwrite"):
    names = M.LANDING_COLUMNS
    data = [tuple(dict({n: "1" for n in names}, status="COMPLETED", payment_method="card", ingestion_ts="2001-07-15 00:00:00",
                       transaction_id=i, transaction_date=d, amount=a)[n] for n in names) for i, d, a in rows]
    spark.createDataFrame(data, io.all_string_schema(names)).coalesce(1).write.mode(mode).option("header", True).csv(path)


D15, D16, D17 = (dt.date(2001, 7, n) for n in (15, 16, 17))


def test_every_landed_row_is_accounted_for(spark):
    root = M.scratch_path(spark, "accounted")
    rows = [("a1", "2001-07-15", "5"), ("a2", "2001-7-15", "6"), ("a3", "2001-07-15", "x"), (None, "2001-07-15", "1"),
            ("b1", "2001-07-16", "7"), ("b2", "2001-07-16", "-1"), ("n1", "N/A", "8"), ("n2", None, "9"), ("n3", "soon", "x"), ("c1", "2001-07-18", "1")]
    _feed(spark, rows, f"{root}/landing")
    for day in (D15, D16, D15, D17):  # the last has no rows
        ctx = _run(spark, root, f"{root}/landing", day)
    got = {r["run_date"]: tuple(r)[1:] for r in M.accounting(ctx).collect()}
    assert got == {"2001-07-15": (4, 4, 2, 2), "2001-07-16": (2, 2, 1, 1), "undated": (3, 0, 0, 3), "2001-07-18": (1, None, None, None)}
    rejects = sorted((r["run_date"], r["transaction_id"] or "", r["reject_reason"]) for r in M.quarantine(ctx).collect())
    assert rejects == [("2001-07-15", "", "null_id"), ("2001-07-15", "a3", "bad_amount"), ("2001-07-16", "b2", "negative_amount"),
                       ("undated", "n1", "bad_date"), ("undated", "n2", "bad_date"), ("undated", "n3", "bad_amount")]
    assert sorted(r[0] for r in spark.read.parquet(f"{root}/silver").select("transaction_id").collect()) == ["a1", "a2", "b1"]
    ltv = spark.read.parquet(f"{root}/gold/customer_ltv").collect()
    assert [(r["total_txns"], r["total_spent"], r["first_txn_date"], r["last_txn_date"]) for r in ltv] == [(3, 18.0, D15, D16)]


def test_the_gate_sees_the_undated_rows_of_a_run(spark):
    root = M.scratch_path(spark, "gated")
    _feed(spark, [(f"a{i}", "2001-07-15", "5") for i in range(9)] + [("n", "N/A", "5")], f"{root}/landing")
    with pytest.raises(RuntimeError, match="quality gate"):
        _run(spark, root, f"{root}/landing", D15, gate=5.0)
    assert _run(spark, root, f"{root}/landing", D15, gate=15.0).counts["undated"] == 1


def test_files_are_counted_once_and_again_when_replaced(spark, monkeypatch):
    root = M.scratch_path(spark, "files")
    src = f"{root}/landing"
    _feed(spark, [("a1", "2001-07-15", "5"), ("n1", "N/A", "5")], src)
    _run(spark, root, src, D15)
    _feed(spark, [("b1", "2001-07-16", "5"), ("b2", "2001-07-16", "5"), ("n2", None, "5")], src, "append")
    read, scan = [], io.csv_bronze_scan
    monkeypatch.setattr(io, "csv_bronze_scan", lambda s, paths, c: read.append(len(paths)) or scan(s, paths, c))
    ctx = _run(spark, root, src, D16)
    assert read == [1, 1]  # the new file is counted, and only the file that holds the day is read
    read.clear()
    ctx = _run(spark, root, src, D16)
    assert read == [1]
    assert {r["run_date"]: r["landed"] for r in M.accounting(ctx).collect()} == {"2001-07-15": 1, "2001-07-16": 2, "undated": 2}
    # A replaced file: its day shrinks to nothing, its undated row has a date now.
    old = next(p for p in M.landed_files(ctx, src).items() if p[0] in {r["source_file"] for r in M.manifest(ctx).where("bronze_date = '2001-07-15'").collect()})
    path = old[1][0].removeprefix("file:")
    with open(path) as f:
        text = f.read().replace("N/A", "2001-07-16").replace("a1", "a11").replace("2001-07-15,", "2001-07-16,")
    with open(path, "w") as f:
        f.write(text)
    for crc in pathlib.Path(path).parent.glob(f".{old[0]}.crc"):
        crc.unlink()
    _run(spark, root, src, D15)
    ctx = _run(spark, root, src, D16)
    assert {r["run_date"]: tuple(r)[1:] for r in M.accounting(ctx).collect()} == {"2001-07-16": (4, 4, 4, 0), "undated": (1, 0, 0, 1)}
    assert spark.read.parquet(f"{root}/silver").where("transaction_date = '2001-07-15'").count() == 0


def test_a_first_full_load_parses_the_feed_once_and_accounts_for_repeats(spark, monkeypatch):
    root = M.scratch_path(spark, "first")
    rows = [("a1", "2001-07-15", "5"), ("a2", "2001-7-16", "6"), ("b1", "2001-07-16", "7")]
    _feed(spark, rows, f"{root}/clean")
    _feed(spark, [*rows, ("n1", "N/A", "8"), ("n1", "N/A", "8"), (None, None, "9")], f"{root}/dirty")
    read, scan = [], io.csv_bronze_scan
    monkeypatch.setattr(io, "csv_bronze_scan", lambda s, paths, c: read.append(len(paths)) or scan(s, paths, c))
    for feed, days, lost, passes in (("clean", {"2001-07-15": 1, "2001-07-16": 2}, 0, 1), ("dirty", {"2001-07-15": 1, "2001-07-16": 2, "undated": 3}, 3, 2)):
        read.clear()
        ctx = M.RunContext.new(spark, root=f"{root}/{feed}_run")
        bronze = M.ingest_bronze(ctx, f"{root}/{feed}", ctx.path("bronze"))
        assert len(read) == passes
        assert (bronze.count(), ctx.counts["input"], ctx.counts["undated"]) == (3, 3, lost)
        assert {r["run_date"]: r["landed"] for r in M.accounting(ctx).collect()} == days
        M.ingest_bronze(ctx, f"{root}/{feed}", ctx.path("bronze"))  # again: the manifest is not counted twice
        assert {r["run_date"]: r["landed"] for r in M.accounting(ctx).collect()} == days
    ctx = M.RunContext.new(spark, root=f"{root}/day", run_date=D15)
    read.clear()
    M.ingest_bronze(ctx, f"{root}/dirty", ctx.path("bronze"))
    assert len(read) == 2 and M.undated(dataclasses.replace(ctx, run_date=None)).count() == 3  # counted once, repeats included


def test_landing_and_tables_are_stored_compressed(spark):
    ctx = M.RunContext.new(spark)
    src, t = M.land_feed(Tables(spark, SF_SMALL), ctx.path("landing")), Tables(spark, SF_SMALL)
    assert all(f.endswith(".csv.gz") for f in M.landed_files(ctx, src)) and M.landed_files(ctx, src)
    M.ingest_bronze(ctx, src, ctx.path("bronze"))
    assert ctx.counts["input"] == FR.bronze_frame(t).count()
    plain = FR.bronze_frame(t).limit(7).select(*[F.col(c).cast("string").alias(c) for c in M.LANDING_COLUMNS])
    plain.write.mode("append").option("header", True).csv(src)  # a plain file beside the others is landed as well
    assert {f.endswith(".gz") for f in M.landed_files(ctx, src)} == {True, False}
    M.transform_silver(ctx, ctx.path("bronze"), FR.merch_frame(t), ctx.path("silver"))
    for table in ("bronze", "silver", "quarantine"):
        files = [p.name for p in pathlib.Path(ctx.path(table)).rglob("*.parquet")]
        assert files and all(f.endswith(".zstd.parquet") for f in files)


def _shuffle_files(spark):
    """Sizes of the shuffle data files that stand on this machine's disk now."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    found = [pathlib.Path(f) for f in files.splitlines() if pathlib.Path(f).name.startswith("shuffle_") and f.endswith(".data")]
    return {str(f): f.stat().st_size for f in found if f.exists()}


def test_a_stage_leaves_no_shuffle_files(spark):
    ctx, t = M.RunContext.new(spark), Tables(spark, SF_SMALL)
    before = _shuffle_files(spark)
    src = M.land_feed(t, ctx.path("landing"))
    M.ingest_bronze(ctx, src, ctx.path("bronze"))
    M.transform_silver(ctx, ctx.path("bronze"), FR.merch_frame(t), ctx.path("silver"))
    M.run_gold(ctx, ctx.path("silver"), ctx.path("gold"))
    until = time.time() + 20  # they are deleted in the background
    while (left := _shuffle_files(spark).keys() - before.keys()) and time.time() < until:
        time.sleep(0.2)
    assert not left


def _odd_rows(spark, n=4000):
    day = F.when(F.col("id") % 11 != 0, F.date_add(F.lit(D15), (F.col("id") % 9).cast("int")))
    text = F.when(F.col("id") % 5 == 0, "").when(F.col("id") % 5 == 1, 'a,"é\n').when(F.col("id") % 5 != 2, F.col("id").cast("string"))
    value = F.when(F.col("id") % 4 == 0, float("nan")).when(F.col("id") % 4 == 1, -0.0).when(F.col("id") % 4 == 2, F.col("id") / 7)
    rows = spark.range(0, n, 1, 4).select(text.alias("x,y"), day.alias("day"), F.col("id").cast("decimal(28,2)").alias("Sum"), value.alias("v"), F.lit(None).cast("string").alias("none"),
                                          F.timestamp_micros(F.col("id") * 777).alias("at"), F.timestamp_micros(F.col("id") * 777).cast("timestamp_ntz").alias("ntz"), F.array("id").alias("ids"))
    return rows.unionAll(rows.where("`Sum` < 50"))


def test_packed_rows_arrive_as_they_were(spark):
    rows = _odd_rows(spark)
    for sent in (rows, rows.limit(0), rows.where("day is null")):
        packed = io.rebalance_packed(sent, "day")
        assert packed.schema.simpleString() == sent.schema.simpleString()
        assert packed.exceptAll(sent).isEmpty() and sent.exceptAll(packed).isEmpty() and packed.count() == sent.count()
    dealt = io.rebalance_packed(rows, "day").withColumn("task", F.spark_partition_id()).groupBy("day").agg(F.count_distinct("task").alias("tasks"))
    assert {r["tasks"] for r in dealt.collect()} == {1}


def test_rows_by_day_travel_packed(spark):
    """The shuffle of a write by day takes at most half the bytes of a plain one."""
    wide = FR.bronze_frame(Tables(spark, SF_SMALL)).crossJoin(spark.range(20)).drop("id")
    wide = wide.select(*[F.col(c).cast("string").alias(c) for c in M.LANDING_COLUMNS]).where("transaction_date is not null").coalesce(2)

    def shuffled(write):
        before = _shuffle_files(spark)
        write()
        return sum(size for f, size in _shuffle_files(spark).items() if f not in before)

    few = wide.withColumn("transaction_date", F.substring("transaction_date", 1, 4))  # a year for a day: a few files
    plain = shuffled(lambda: few.hint("rebalance", "transaction_date").write.format("noop").mode("overwrite").save())
    path = M.scratch_path(spark, "packed")
    assert 0 < shuffled(lambda: io.write_partitioned(few, path, "transaction_date")) < plain / 2
    assert spark.read.parquet(path).count() == few.count()


def test_a_hot_day_is_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(io, "PACK_BYTES", 1 << 16)
    monkeypatch.setattr(io, "PACKED_TASK", 1 << 16)
    rows = spark.range(0, 80000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("x"), F.when(F.col("id") % 100 == 0, D16).otherwise(D15).alias("day"))
    path = M.scratch_path(spark, "hot")
    io.write_partitioned(rows, path, "day")
    files = {d: len(list(pathlib.Path(path, f"day={d}").glob("*.parquet"))) for d in (D15, D16)}
    assert files[D15] > 1 and spark.read.parquet(path).count() == 80000

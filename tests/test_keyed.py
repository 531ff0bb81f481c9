"""Keyed targets: what an insert reads, replays, and failures between write and commit."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path
from ledgerlake.sources import keyed
from ledgerlake.sources.keyed import KeyedTable
from ledgerlake.streaming import jobs
from ledgerlake.sources.tables import Tables

from .conftest import SF_SMALL


def _rows(spark, ids, tag="a"):
    return spark.createDataFrame([(i, tag) for i in ids], "id string, tag string")


def _ids(*parts):
    return [f"k{i}" for part in parts for i in part]


def _held(table):
    return sorted((r["id"], r["tag"]) for r in table.read().collect())


def test_reads_follow_the_batch(spark):
    table = KeyedTable(spark, scratch_path(spark, "keyed"), "id", buckets=16)
    first = table.insert_absent(_rows(spark, _ids(range(4000))), [F.col("tag")])
    assert (first.rows, first.candidates, first.partitions) == (4000, 0, 0)
    assert table.insert_absent(_rows(spark, _ids(range(4000, 8000)), "b"), [F.col("tag")]).rows == 4000
    # Three known keys of the first load and new ones: at most three of the 32 buckets of loads, and a few by chance.
    few = table.insert_absent(_rows(spark, _ids([7, 8, 9], range(9000, 9020)), "c"), [F.col("tag")])
    assert few.rows == 20 and few.partitions == 32 and few.candidates <= 5
    # All new: the filters answer, next to nothing is read.
    new = table.insert_absent(_rows(spark, _ids(range(20_000, 20_030)), "d"), [F.col("tag")])
    assert new.rows == 30 and new.candidates <= 4
    files = table._stored("data", ["_load=0/_bucket=3"]).inputFiles()
    assert files and all("_load=0/_bucket=3" in f for f in files)
    assert _held(table) == sorted([(k, "a") for k in _ids(range(4000))] + [(k, "b") for k in _ids(range(4000, 8000))]
                                  + [(k, "c") for k in _ids(range(9000, 9020))] + [(k, "d") for k in _ids(range(20_000, 20_030))])


def test_filters_have_no_false_negatives_and_few_false_positives(spark):
    table = KeyedTable(spark, scratch_path(spark, "keyed"), "id", buckets=8)
    table.insert_absent(_rows(spark, _ids(range(5000))), [F.col("tag")])
    assert table.may_hold(_rows(spark, _ids(range(5000)))).count() == 5000
    assert table.may_hold(_rows(spark, _ids(range(50_000, 60_000)))).count() < 300  # 10,000 keys that are not there


def test_first_row_per_key_nulls_and_empty_batches(spark):
    table = KeyedTable(spark, scratch_path(spark, "keyed"), "id")
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.insert_absent(_rows(spark, []), [F.col("tag")]).rows == 0
    assert table.read().columns == ["id", "tag"] and table.read().count() == 0 and table.last().count() == 0
    batch = spark.createDataFrame([("x", "b"), ("x", "a"), (None, "a"), ("y", "c"), ("y", "c")], "id string, tag string")
    assert table.insert_absent(batch, [F.col("tag")]).rows == 2
    assert _held(table) == [("x", "a"), ("y", "c")]
    with pytest.raises(ValueError, match="keyed by id"):
        KeyedTable(spark, table.path, "tag")


def test_against_a_set(spark):
    r = random.Random(1)
    table, known = KeyedTable(spark, scratch_path(spark, "keyed"), "id", buckets=4), {}
    for load in range(5):
        ids = [r.randrange(400) for _ in range(150)]
        inserted = table.insert_absent(_rows(spark, _ids(ids), f"t{load}"), [F.col("tag")])
        new = {f"k{i}" for i in ids} - known.keys()
        known |= {k: f"t{load}" for k in new}
        assert inserted.rows == len(new) == table.last().count()
    assert _held(table) == sorted(known.items())
    table.compact()
    assert len(table.loads()) == 1 and _held(table) == sorted(known.items())
    assert table.insert_absent(_rows(spark, _ids(range(400)), "z"), [F.col("tag")]).rows == 400 - len(known)


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_failure_around_the_commit_leaves_no_repeat_and_no_loss(spark, monkeypatch, when):
    table = KeyedTable(spark, scratch_path(spark, "keyed"), "id", buckets=4)
    table.insert_absent(_rows(spark, _ids(range(50))), [F.col("tag")], "w", 0)
    commit = keyed.Ledger.commit

    def fails(self, **values):
        if when == "after":
            commit(self, **values)
        raise OSError("lost")

    monkeypatch.setattr(keyed.Ledger, "commit", fails)
    with pytest.raises(OSError):
        table.insert_absent(_rows(spark, _ids(range(40, 90)), "b"), [F.col("tag")], "w", 1)
    monkeypatch.undo()
    assert len(_held(table)) == (50 if when == "before" else 90)
    # Another batch comes first in between; what the dead run left is not taken for its rows.
    table.insert_absent(_rows(spark, ["other"], "o"), [F.col("tag")], "v", 1)
    again = table.insert_absent(_rows(spark, _ids(range(40, 90)), "b"), [F.col("tag")], "w", 1)
    assert again.repeated == (when == "after") and again.rows == 40
    assert _held(table) == sorted([(k, "a") for k in _ids(range(50))] + [(k, "b") for k in _ids(range(50, 90))] + [("other", "o")])


def test_a_stream_that_dies_before_its_commit_resumes(spark, monkeypatch):
    p = jobs.paths(spark, "dying_stream")
    events = Tables(spark, SF_SMALL).events
    jobs.land_event_files(events, p["src"], files=4)
    commit, died = keyed.Ledger.commit, []

    def fails_once(self, **values):
        if values["epoch"] == 1 and not died:
            died.append(1)
            raise OSError("lost")
        commit(self, **values)

    monkeypatch.setattr(keyed.Ledger, "commit", fails_once)
    with pytest.raises(Exception, match="lost"):
        jobs.stream_silver_upsert(spark, p["src"], p["sink"], p["checkpoint"], files_per_trigger=2)
    out = jobs.stream_silver_upsert(spark, p["src"], p["sink"], p["checkpoint"], files_per_trigger=2)
    assert died and out.count() == out.select("event_id").distinct().count() == events.select("event_id").distinct().count()


def test_an_insert_deals_its_rows_by_key_once(spark, monkeypatch):
    table = KeyedTable(spark, scratch_path(spark, "keyed"), "id", buckets=4)
    kept, materialize = [], keyed.materialize
    monkeypatch.setattr(keyed, "materialize", lambda df, name="": kept.append(name) or materialize(df, name))
    table.insert_absent(_rows(spark, _ids(range(50))), [F.col("tag")])
    assert kept == []  # nothing is there yet: the rows go straight into the load
    plans, write = [], KeyedTable._write
    monkeypatch.setattr(KeyedTable, "_write", lambda self, n, rows: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or write(self, n, rows))
    assert table.insert_absent(_rows(spark, [*_ids(range(40, 60), range(55, 60))], "b"), [F.col("tag")]).rows == 10
    assert plans[0].count("Window [") == 1 and "LeftAnti" not in plans[0]
    assert _held(table) == sorted([(k, "a") for k in _ids(range(50))] + [(k, "b") for k in _ids(range(50, 60))])

"""Gold by day equals a recompute of everything, whatever is re-run, and reads its days and the state only."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from ledgerlake.operators import aggregates as A
from ledgerlake.operators import incremental as INC
from ledgerlake.session import scratch_path
from ledgerlake.sources import keyed

SCHEMA = "customer_id bigint, payment_method string, amount decimal(18,2), transaction_date date, status string"


def _day(n):
    return dt.date(2001, 7, 1) + dt.timedelta(days=n)


def _frame(spark, by_day):
    return spark.createDataFrame([(c, m, None if a is None else Decimal(a), _day(n), "COMPLETED") for n, rows in by_day.items() for c, m, a in rows], SCHEMA)


def _some(r, n):
    return [(r.choice([1, 2, 3, 4, None]), r.choice(["card", "cash", None]), r.choice([Decimal(r.randrange(10_000)) / 100, None])) for _ in range(n)]


def _table(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_recompute(spark, seed):
    r = random.Random(seed)
    days = {n: _some(r, r.randrange(6)) for n in range(6)}
    state = INC.ltv_state(spark, scratch_path(spark, "ltv"))
    state.apply(_frame(spark, days))
    for step in range(5):
        n = r.choice([0, 5, 6 + step, r.randrange(6)])  # the first and the last day among them
        days[n] = [] if r.random() < 0.3 else _some(r, 4)
        got = INC.customer_ltv(state.apply(_frame(spark, {n: days[n]}), [_day(n)]))
        assert _table(got) == _table(A.customer_ltv(_frame(spark, days)).select(*got.columns))


def test_a_run_reads_its_day_and_the_totals(spark):
    days = {n: [(c, "card", 5) for c in range(3)] for n in range(5)}
    state = INC.ltv_state(spark, scratch_path(spark, "ltv"))
    state.apply(_frame(spark, days))
    read = []
    whole = state._days
    state._days = lambda d: read.append(dict(d)) or whole(d)
    state.apply(_frame(spark, {4: [(0, "card", 7), (1, "card", 7), (2, "card", 7)]}), [_day(4)])
    assert read == [{str(_day(4)): 1}, {str(_day(4)): 0}]  # the day as it is and as it was
    read.clear()
    state.apply(_frame(spark, {4: [(0, "card", 7)]}), [_day(4)])  # two customers lose their last day: only then the days are looked at
    assert len(read) == 3 and len(read[2]) == 5
    assert {x["customer_id"]: str(x["last_day"]) for x in state.totals().collect()} == {0: str(_day(4)), 1: str(_day(3)), 2: str(_day(3))}


def test_a_run_that_dies_changes_nothing(spark, monkeypatch):
    days = {0: [(1, "card", 5)], 1: [(1, "cash", 6), (2, "card", 1)]}
    state = INC.ltv_state(spark, scratch_path(spark, "ltv"))
    state.apply(_frame(spark, days))
    before = _table(state.totals())
    monkeypatch.setattr(keyed.Ledger, "commit", lambda self, **values: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        state.apply(_frame(spark, {1: [(3, "card", 9)], 2: [(3, "card", 9)]}), [_day(1), _day(2)])
    monkeypatch.undo()
    assert _table(state.totals()) == before
    days[1] = [(2, "card", 1)]
    assert _table(INC.customer_ltv(state.apply(_frame(spark, {1: days[1]}), [_day(1)]))) == _table(A.customer_ltv(_frame(spark, days)))


def test_no_rows(spark):
    state = INC.ltv_state(spark, scratch_path(spark, "ltv"))
    assert state.apply(_frame(spark, {})).collect() == []
    assert state.apply(_frame(spark, {}), [_day(0)]).collect() == []
    assert len(state.apply(_frame(spark, {0: [(1, "card", 5)]}), [_day(0)]).collect()) == 1
    assert state.apply(_frame(spark, {}), [_day(0)]).collect() == []

"""Every registered query against its oracle SQL on DuckDB (sf0.001).

The same comparison the driver runs: column names, row count and every value
(order-insensitive). Keys that write a folder for each of thousands of dates are slow on
a laptop file system; they run on the line items of a few weeks (the sf0.01
sweep in tools/oracle_check.py covers them in full).
"""

import datetime as dt
import os
import sys

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import canon, duck, duck_type  # noqa: E402

from ledgerlake.plans.catalog import load_all  # noqa: E402
from ledgerlake.sources.tables import TABLE_NAMES  # noqa: E402

from .conftest import SF_SMALL  # noqa: E402

FEW_DAYS = {"partition_pruned_read", "idempotent_overwrite", "run_metadata_sink", "ingest_bronze", "transform_silver", "run_medallion",
            "parquet_partitioned_write", "run_gold"}
KEYS = sorted(load_all())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.fixture(scope="module")
def few_days(tmp_path_factory):
    """The tables with the line items shipped from July 2001 on."""
    folder = tmp_path_factory.mktemp("few_days")
    for name in TABLE_NAMES:
        table = pq.read_table(f"{SF_SMALL}/{name}.parquet")
        if name == "lineitem":
            table = table.filter(pc.greater_equal(table["l_shipdate"], pa.scalar(dt.datetime(2001, 7, 1), table["l_shipdate"].type)))
        pq.write_table(table, folder / f"{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, few_days, key):
    folder, con = (few_days, duck(few_days)) if key in FEW_DAYS else (SF_SMALL, con)
    q = load_all()[key]
    assert q.sql is not None, f"{key} has no oracle SQL"
    df = q.run(spark, folder)
    sc, sr = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(q.sql)
    dc, dr = canon([d[0] for d in cur.description], cur.fetchall())
    assert sc == dc
    rel = con.sql(q.sql)
    assert dict(df.dtypes) == dict(zip(rel.columns, [duck_type(x) for x in rel.types]))
    assert len(sr) == len(dr)
    assert sr == dr

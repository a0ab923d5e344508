"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import duckdb
import pytest

import __spark_entry__ as entry
from fleetlake import oracle
from fleetlake.plans import registry
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    missing = set(registry.QUERIES) - set(entry.oracle_sql())
    assert missing <= {"encode_events"}  # its JSON text; encoded_* compare the decoded fields


@pytest.mark.parametrize("key", sorted(oracle.QUERIES))
def test_query_matches_oracle(spark, con, key):
    sdf = entry.queries()[key](spark, SF)
    s_rows = [r.asDict() for r in sdf.collect()]
    rel = con.execute(entry.oracle_sql()[key])
    cols = [d[0] for d in rel.description]
    d_rows = [dict(zip(cols, r)) for r in rel.fetchall()]
    assert sorted(sdf.columns) == sorted(cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_rows, sorted(cols), 9) == rows_of(d_rows, sorted(cols), 9)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "drift_flag" in df.columns

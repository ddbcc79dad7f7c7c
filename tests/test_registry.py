"""Every registered query against its DuckDB SQL (small scale), plus the
driver contract."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "scripts"))
from check_oracle import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert q and set(o) <= set(q)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "occurrence_number" in df.columns


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols, drows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert rows_of(cols, rows) == rows_of(dcols, drows)

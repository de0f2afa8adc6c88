"""Every registered query against its DuckDB oracle (sf0.001), the way the
driver compares them: column names, row count, multiset of values."""

import os

import duckdb
import pytest

from tests.conftest import SF001
from tools.check_oracle import TABLES, rows_of

import __spark_entry__ as entry
from framecut.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    """All queries of the engine itself; the optional operators name their own."""
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "string_time" in df.columns


def test_clips_json_rows(spark):
    q = entry.queries()
    assert q["clips_json"](spark, SF001).count() == q["clips_all"](spark, SF001).count()

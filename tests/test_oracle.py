"""Every registered query against its DuckDB oracle at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SMOKE
from tools.check_oracle import TABLES, canon


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMOKE)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert canon(srows, scols, 12) == canon(drows, dcols, 12)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_runs" in df.columns


def test_rows_only_queries(spark):
    for name in sorted(set(E.queries()) - set(E.oracle_sql())):
        assert E.queries()[name](spark, SMOKE).count() > 0, name


def test_the_oracle_takes_nothing_from_the_library():
    folder = os.path.join(os.path.dirname(E.__file__), "oracle")
    for name in os.listdir(folder):
        if name.endswith(".py"):
            with open(os.path.join(folder, name)) as fh:
                assert "scorelake" not in fh.read(), name

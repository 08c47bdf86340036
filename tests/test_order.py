"""Row order of the ranking queries (their oracles compare rows as sets)."""

import duckdb
import pytest

import __spark_entry__ as E
from oracle import sql as O
from scorelake.operators import board
from tests.conftest import SMOKE
from tools.check_oracle import TABLES

#: The orders, written out here independently of the library.
RANKINGS = {
    "batsmen": "total_runs DESC NULLS FIRST, total_matches DESC NULLS FIRST",
    "bowler": "total_wickets DESC NULLS FIRST, total_matches DESC NULLS FIRST",
    "fielder": "total_catches DESC NULLS FIRST, total_wicket_keeper_catches DESC NULLS FIRST, "
               "total_stumpings DESC NULLS FIRST",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


@pytest.mark.parametrize("role", sorted(RANKINGS))
@pytest.mark.parametrize("kind", ["rankings", "ranking_view"])
def test_rankings_in_order(spark, duck, kind, role):
    want = duck.execute(f"SELECT full_name, country FROM ({E.oracle_sql()[f'rankings_{role}']}) "
                        f"ORDER BY {RANKINGS[role]}, full_name, country").fetchall()
    assert rows(E.queries()[f"{kind}_{role}"](spark, SMOKE), "full_name", "country") == want


@pytest.mark.parametrize("query,column", [("country_sorted", "total_dismissals"),
                                          ("country_sorted_batsmen", "total_runs"),
                                          ("country_sorted_bowler", "total_wickets")])
def test_countries_in_order(spark, duck, query, column):
    want = duck.execute(f"SELECT country FROM ({E.oracle_sql()[query]}) "
                        f"ORDER BY {O.num(column)} DESC, country").fetchall()
    assert rows(E.queries()[query](spark, SMOKE), "country") == want


def test_names_in_order(spark, duck):
    want = duck.execute(f"SELECT full_name FROM ({E.oracle_sql()['player_names']}) "
                        "ORDER BY lower(full_name), full_name").fetchall()
    assert rows(E.queries()["player_names"](spark, SMOKE), "full_name") == want


def test_order_with_nulls_and_ties(spark):
    from scorelake.operators import serve
    keys = serve.RANKING_KEYS["batsmen"]
    table = spark.createDataFrame(
        [("B", "X", 5, 1), ("A", "X", 5, 1), ("C", "X", None, None), ("D", "X", 9, 1), ("E", "X", 5, None)],
        f"full_name string, country string, {keys[0]} long, {keys[1]} long")
    assert [r[0] for r in rows(serve.rankings(table, "batsmen"), "full_name")] == ["C", "D", "E", "A", "B"]
    stats = spark.createDataFrame([("P", None), ("Q", 3), ("O", 0), ("R", 3)],
                                  "country string, total_dismissals long")
    assert [r[0] for r in rows(board.country_sorted(stats, "fielder"), "country")] == ["Q", "R", "O", "P"]


def test_names_in_locale_order(spark):
    names = ["Zed", "Émile", "adam", "Eve", "Ådam B", "Adam", "Emil"]
    frame = spark.createDataFrame([(n, "ODI") for n in names + ["Eve", "", None]], "full_name string, format string")
    assert [r[0] for r in rows(board.player_names(frame, "ODI"), "full_name")] == [
        "adam", "Adam", "Ådam B", "Emil", "Émile", "Eve", "Zed"]

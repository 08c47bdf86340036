"""Serving queries: projections, country rollup and filter, rankings, checks."""

import json

import pytest
from pyspark.sql import functions as F

from scorelake.operators import serve
from scorelake.specs import COUNTRIES


def test_player_projection_aliases(smoke_cards):
    t20 = smoke_cards.players("bowler", "T20")
    assert "balls" in t20.columns and "maidens" in t20.columns and "Overs" not in t20.columns
    test = smoke_cards.players("bowler", "Test")
    assert {"best_match", "ten_wicket_hauls"} <= set(test.columns)
    allf = smoke_cards.players("batsmen", "All")
    assert "runs" in allf.columns and "balls_faced" not in allf.columns
    assert allf.count() == smoke_cards.silver("batsmen").count()


def test_argument_checks(smoke_cards):
    with pytest.raises(ValueError):
        smoke_cards.players("umpire", "ODI")
    with pytest.raises(ValueError):
        smoke_cards.players("batsmen", "T10")
    with pytest.raises(ValueError):
        smoke_cards.country_stats("batsmen", "Hundred")


def test_country_filter_is_filter_of_full(smoke_cards):
    full = {r.country: r for r in smoke_cards.country_stats("batsmen", "All").collect()}
    for c in list(full)[:3]:
        one = smoke_cards.country_stats("batsmen", "All", c).collect()
        assert len(one) == 1 and one[0] == full[c]


def test_country_all_is_rollup(smoke_cards):
    per = smoke_cards.country_table("fielder")
    allf = smoke_cards.country_stats("fielder", "All")
    assert allf.agg(F.sum("total_catches")).collect()[0][0] == \
        per.agg(F.sum("total_catches")).collect()[0][0]
    assert {r.format for r in allf.select("format").distinct().collect()} == {"All"}


def test_rankings_order_nulls_first(spark):
    t = spark.createDataFrame(
        [("A", "India", 10, 5), ("B", "India", None, 1), ("C", "India", 10, 7), ("D", "India", 3, 9)],
        "full_name string, country string, total_runs long, total_matches long")
    order = [r.full_name for r in serve.rankings(t, "batsmen").collect()]
    assert order == ["B", "C", "A", "D"]


def test_countries_sorted_distinct(spark):
    got = [r.country for r in serve.countries(spark).collect()]
    assert got == sorted(set(got)) == list(COUNTRIES) and len(got) == 22


def test_json_records(smoke_cards):
    rows = serve.json_records(smoke_cards.country_stats("bowler", "ODI")).collect()
    rec = json.loads(rows[0].json)
    assert {"country", "format", "average_economy"} <= set(rec)


def test_sql_views(spark, smoke_cards):
    names = smoke_cards.register_views(prefix="t_")
    assert len(names) == 24
    a = spark.sql("SELECT sum(total_runs) FROM t_odi_batsmen_stats_country_wise").collect()[0][0]
    b = spark.sql('SELECT sum("Runs") FROM t_batsmen_odi'.replace('"', "`")).collect()[0][0]
    assert a == b
    cols = spark.table("t_bowler_test").columns
    assert "BBM" in cols and "Overs" not in cols

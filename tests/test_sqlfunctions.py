"""P1-P6 as SQL table functions over a refreshed lake."""

import uuid

import pytest

from scorelake.operators import serve
from scorelake.plans import sqlfunctions
from scorelake.plans.layers import Scorecards
from scorelake.plans.refresh import refresh
from scorelake.specs import ALL, FORMATS, ROLES, spec


@pytest.fixture(scope="module")
def lake(spark, smoke_cards):
    root = f"{spark.conf.get('spark.checkpoint.dir')}/functions-{uuid.uuid4().hex}"
    refresh(spark, root, raw={r: smoke_cards.raw(r) for r in ROLES})
    cards = Scorecards.from_lake(spark, root)
    assert sqlfunctions.register(cards) == ["players", "country_stats", "rankings"]
    return cards


def _canon(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("role", ROLES)
def test_functions_equal_the_library(spark, lake, role):
    for fmt in (*FORMATS, ALL):
        cols = ", ".join(f"`{out}`" for _, out in spec(role).serve[fmt])
        assert _canon(spark.sql(f"SELECT {cols} FROM players('{role}', '{fmt}')")) == _canon(lake.players(role, fmt))
        cols = ", ".join(serve.COUNTRY_COLUMNS[role])
        assert _canon(spark.sql(f"SELECT {cols} FROM country_stats('{role}', '{fmt}')")) == _canon(
            lake.country_stats(role, fmt))
    cols = ", ".join(f"`{c}`" for c in lake.rankings(role).columns)
    ranked = spark.sql(f"SELECT {cols} FROM rankings('{role}') ORDER BY position")
    assert [tuple(r) for r in ranked.collect()] == [tuple(r) for r in lake.rankings(role).collect()]


def test_only_the_asked_files_are_scanned(spark, lake):
    plan = _plan(spark.sql("SELECT * FROM country_stats('bowler', 'ODI') WHERE country = 'Pakistan'"))
    assert plan.count("FileScan") == 1 and "PushedFilters: [IsNotNull(country), EqualTo(country,Pakistan)]" in plan
    assert "PartitionFilters: [isnotnull(format" in plan
    plan = _plan(spark.sql("SELECT position, full_name FROM rankings('fielder') WHERE position <= 25"))
    assert plan.count("FileScan") == 1 and "LessThanOrEqual(position,25)" in plan


@pytest.mark.parametrize("call", ["players('umpire', 'ODI')", "players('bowler', 'T10')", "country_stats('bowler', NULL)",
                                  "rankings('x')"])
def test_arguments_are_checked(spark, lake, call):
    with pytest.raises(Exception, match="invalid role or format"):
        spark.sql(f"SELECT * FROM {call}").collect()

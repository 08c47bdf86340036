"""Plan checks: no Python evaluation, pushdown/pruning, top-k operators."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SMOKE

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow", "FlatMapGroupsInArrow")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


#: The text operators choose their style themselves and have tests of their own.
LIBRARY = sorted(n for n in E.queries() if not re.match(r"op\d+_|pipeline$", n))


@pytest.mark.parametrize("name", LIBRARY)
def test_no_python_in_plans(spark, name):
    if name in ("refresh_all", "lake_roundtrip", "refresh_one_name", "reader_across_refreshes", "catalog_tables"):
        pytest.skip("writes a lake; covered by test_lake")
    plan = _plan(E.queries()[name](spark, SMOKE))
    assert not any(n in plan for n in PY_NODES), name


def test_topk_is_take_ordered(spark):
    for name in ("format_ranking_batsmen", "leaderboard_sum", "suggestions"):
        plan = _plan(E.queries()[name](spark, SMOKE))
        assert "TakeOrderedAndProject" in plan, name


def test_scan_prunes_columns(spark):
    plan = _plan(E.queries()["player_all_fielder"](spark, SMOKE))
    li = [ln for ln in plan.splitlines() if "lineitem" in ln and "FileScan" in ln][0]
    assert "l_extendedprice" not in li and "l_partkey" not in li


def test_country_filter_reaches_partition_of_lake(spark, smoke_cards, tmp_path):
    import uuid
    from scorelake.plans.layers import Scorecards
    from scorelake.plans.refresh import refresh
    root = f"{spark.conf.get('spark.checkpoint.dir')}/lake-{uuid.uuid4().hex}"
    from scorelake.specs import ROLES
    refresh(spark, root, raw={r: smoke_cards.raw(r) for r in ROLES}, roles=ROLES)
    lake = Scorecards.from_lake(spark, root)
    plan = _plan(lake.country_stats("bowler", "ODI", "Pakistan"))
    assert "PartitionFilters: [isnotnull(format" in plan
    assert "PushedFilters: [IsNotNull(country), EqualTo(country,Pakistan)]" in plan


@pytest.mark.parametrize("name", [n for n in LIBRARY if n.endswith("_named") and not n.startswith("stored_")])
def test_named_player_is_a_literal_filter(spark, name):
    plan = _plan(E.queries()[name](spark, SMOKE))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    scans = [ln for ln in plan.splitlines() if "FileScan" in ln and "lineitem" in ln]
    assert len(scans) == 1, scans


def test_named_player_reaches_the_scan_of_the_lake(spark, smoke_cards):
    import uuid
    from scorelake.operators import board
    from scorelake.plans.layers import Scorecards
    from scorelake.plans.refresh import refresh
    root = f"{spark.conf.get('spark.checkpoint.dir')}/lake-{uuid.uuid4().hex}"
    refresh(spark, root, raw={"batsmen": smoke_cards.raw("batsmen")}, roles=("batsmen",))
    rows = Scorecards.from_lake(spark, root).rows("batsmen")
    plan = _plan(board.player_header(rows, "batsmen", "ODI", "Customer#000000005"))
    assert "EqualTo(full_name,Customer#000000005)" in plan
    assert "PartitionFilters: [isnotnull(format" in plan

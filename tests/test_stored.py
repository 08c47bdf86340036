"""What a refresh stores for serving: positions, cards, availability, the index of names."""

import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from scorelake.operators import board, positions
from scorelake.plans.layers import Scorecards
from scorelake.plans.refresh import refresh
from scorelake.specs import FORMATS, ROLES, spec


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _root(spark):
    return f"{spark.conf.get('spark.checkpoint.dir')}/stored-{uuid.uuid4().hex}"


@pytest.fixture(scope="module")
def lake(spark, smoke_cards):
    root = _root(spark)
    refresh(spark, root, raw={r: smoke_cards.raw(r) for r in ROLES})
    return Scorecards.from_lake(spark, root)


@pytest.fixture(scope="module")
def rows_of(lake):
    """The board rows of each role, over the stored silver rows."""
    return {r: lake.rows(r).cache() for r in ROLES}


BOARD_FORMAT = {"batsmen": "ODI", "bowler": "Test", "fielder": "T20"}


def _rows(df):
    return [tuple(r) for r in df.collect()]


def _canon(df):
    def norm(v):
        return round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(map(norm, r)) for r in df.collect()), key=repr)


# ------------------------------------------------------------------- positions
def test_positions_follow_the_order_in_every_group(spark):
    rnd = random.Random(1)
    # a third of the rows tie on one value of one group; nulls first; equal rows
    rows = [("a" if i % 3 == 0 else rnd.choice("abc"), 7 if i % 3 == 0 else rnd.choice([None, *range(20)]), f"n{i % 200}")
            for i in range(900)]
    df = spark.createDataFrame(rows, "g string, v int, name string").repartition(7)
    got = positions.numbered(df, [F.col("v").desc_nulls_first(), F.col("name")], _root(spark), ("g",), "size").collect()
    assert len(got) == len(rows)
    for g in "abc":
        mine = sorted((r for r in got if r.g == g), key=lambda r: r.position)
        want = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, -(r[1] or 0), r[2]))
        assert [(r.g, r.v, r.name) for r in mine] == want
        assert [r.position for r in mine] == list(range(1, len(want) + 1)) and {r["size"] for r in mine} == {len(want)}


def test_positions_of_an_empty_table(spark):
    df = spark.createDataFrame([], "v int")
    assert positions.numbered(df, [F.col("v")], _root(spark)).count() == 0


def test_pages_read_their_blocks_only(spark, monkeypatch):
    monkeypatch.setattr(positions, "BLOCK_ROWS", 50)
    root = _root(spark)
    positions.write_numbered(positions.numbered(spark.range(1000).select(F.col("id").alias("v")), [F.col("v").desc()],
                                                f"{root}/s"), f"{root}/t")
    stored = spark.read.parquet(f"{root}/t")
    for first, last in ((1, 25), (40, 130), (991, 1200), (5, 5)):
        page = positions.page(stored, first, last)
        assert [r.v for r in page.collect()] == [1000 - p for p in range(first, min(last, 1000) + 1)]
        plan = _plan(page)
        assert "PartitionFilters: [isnotnull(block" in plan and "GreaterThanOrEqual(position" in plan
    read = stored.where("block = 8").select("v", "position", "block")  # all that the page below may touch
    assert sorted(_rows(positions.page(stored, 401, 425))) == sorted(_rows(positions.page(read, 401, 425)))
    for bad in ((0, 5), (9, 8)):
        with pytest.raises(ValueError):
            positions.page(stored, *bad)


@pytest.mark.parametrize("role", ROLES)
def test_ranking_pages_are_slices_of_the_ranking(lake, smoke_cards, role):
    whole = _rows(smoke_cards.rankings(role))
    assert _rows(lake.rankings(role)) == whole
    for first, last in ((1, 25), (31, 60), (len(whole) - 3, len(whole) + 10)):
        page = _rows(lake.ranking_page(role, first, last))
        assert [r[:-1] for r in page] == whole[first - 1:last]
        assert [r[-1] for r in page] == list(range(first, min(last, len(whole)) + 1))
    plan = _plan(lake.ranking_page(role))
    assert "Exchange" not in plan and "PartitionFilters: [isnotnull(block" in plan


@pytest.mark.parametrize("role", ROLES)
def test_format_and_player_pages(lake, rows_of, role):
    rows = rows_of[role]
    for fmt in FORMATS[:2] if role == "bowler" else FORMATS[2:]:
        want = _rows(board.format_ranking(rows, role, fmt, top=60))
        assert [r[1:] for r in _rows(lake.format_ranking_page(role, fmt, 1, 25))] == want[:25]
        assert [r[1:] for r in _rows(lake.format_ranking_page(role, fmt, 26, 60))] == want[25:]
        ranked = [(n, v, c) for n, v, c in _rows(board.ranked_players(rows, role, fmt))]
        assert [r[1:] for r in _rows(lake.ranked_page(role, fmt, 11, 40))] == ranked[10:40]


def test_positions_need_a_lake(smoke_cards):
    with pytest.raises(ValueError, match="stored by a refresh"):
        smoke_cards.ranking_page("bowler")


# ----------------------------------------------------- the board on stored cards
ONE = ("kpis", "profile", "versus_card", "format_bars", "best_format", "player_header")
PAIR = ("versus", "versus_by_format", "compare_header")


@pytest.mark.parametrize("role", ROLES)
@pytest.mark.parametrize("name", ONE)
def test_cards_stand_in_for_rows_for_one_player(lake, rows_of, role, name):
    rows, stored, f, fmt = rows_of[role], lake.board(role), getattr(board, name), BOARD_FORMAT[role]
    for player in (None, "Customer#000000042", "Nobody"):
        assert _canon(f(stored, role, fmt, player)) == _canon(f(rows, role, fmt, player)), player


@pytest.mark.parametrize("role", ROLES)
@pytest.mark.parametrize("name", PAIR)
def test_cards_stand_in_for_rows_for_a_pair(lake, rows_of, role, name):
    rows, stored, f = rows_of[role], lake.board(role), getattr(board, name)
    best, *_, some = [r.full_name for r in board.ranked_players(rows, role, "T20").limit(30).collect()]
    for pair in ((None, None), (best, None), (None, some), ("Nobody", None)):
        assert _canon(f(stored, role, "T20", *pair)) == _canon(f(rows, role, "T20", *pair)), pair


@pytest.mark.parametrize("role", ROLES)
def test_lists_on_cards(lake, rows_of, role):
    rows, stored = rows_of[role], lake.board(role)
    assert _canon(board.metric_availability(stored, role)) == _canon(board.metric_availability(rows, role))
    assert _rows(board.default_and_rival(stored, role, "Test")) == _rows(board.default_and_rival(rows, role, "Test"))
    assert _rows(board.player_names(stored, "ODI")) == _rows(board.player_names(rows, "ODI"))
    for metric in spec(role).metrics[:3]:
        assert _canon(board.leaderboard(stored, role, "T20", metric)) == _canon(board.leaderboard(rows, role, "T20", metric))
    assert _canon(board.player_count(*[lake.board(r) for r in ROLES])) == _canon(
        board.player_count(*rows_of.values()))


def test_a_lone_player_is_his_own_rival(spark, smoke_cards):
    name = smoke_cards.rows("fielder").where("format = 'ODI'").agg(F.min("full_name")).first()[0]
    root = _root(spark)
    raw = smoke_cards.raw("fielder").where(F.col("Player").startswith(name))
    refresh(spark, root, raw={"fielder": raw}, roles=("fielder",))
    rows, stored = Scorecards.from_raw(spark, {"fielder": raw}).rows("fielder"), Scorecards.from_lake(spark, root).board("fielder")
    for f in (board.versus, board.compare_header, board.versus_by_format):
        assert _canon(f(stored, "fielder", "ODI")) == _canon(f(rows, "fielder", "ODI"))


def test_a_named_player_reads_one_card_and_the_flags(lake):
    plan = _plan(board.kpis(lake.board("batsmen"), "batsmen", "ODI", "Customer#000000005"))
    scans = [x for x in plan.splitlines() if "FileScan" in x]
    assert len(scans) == 2 and sum("EqualTo(full_name,Customer#000000005)" in x for x in scans) == 1
    assert "PartitionFilters: [isnotnull(format" in plan and "Join" not in plan
    assert "silver" not in plan


def test_the_default_pair_reads_the_first_two_positions(lake):
    plan = _plan(board.versus(lake.board("bowler"), "bowler", "Test"))
    assert "Join" not in plan and "Window" not in plan and "silver" not in plan
    assert re.search(r"PushedFilters: \[[^\]]*position", plan) and re.search(r"PartitionFilters: \[[^\]]*block", plan)


# ----------------------------------------------------------------- name search
@pytest.mark.parametrize("role", ["batsmen"])
def test_search_equals_the_scan_for_every_query(lake, rows_of, role):
    rows, stored = rows_of[role], lake.board(role)
    queries = ["", "c", "er", "tom", "#000", "00001", "000000042", "customer#00000011", "0000", "zzz", "  MER#0 ", "01 ", "(", "a\\b"]
    for q in queries:
        assert _rows(board.suggestions(stored, role, "ODI", q)) == _rows(board.suggestions(rows, role, "ODI", q)), q
    assert _rows(board.suggestions(stored, role, "ODI", "mer#", exclude_selected=True)) == _rows(
        board.suggestions(rows, role, "ODI", "mer#", exclude_selected=True))


def test_search_of_names_with_repeats_and_other_scripts(spark):
    names = ["Ana Banana", "banANA", "AnAn", "ananas", "Ünal Über", "李小龍 Lee", "an", "", "İnal", "naan", "x" * 3000 + "needle"]
    cards = spark.createDataFrame([(n, "ODI", i + 1, float(i), "India") for i, n in enumerate(names)],
                                  "full_name string, format string, position long, value double, country string")
    index = board.postings(cards)
    for q in ("ana", "anan", "nana", "anana", "ünal", "李小龍", "needle", "naan", "xxx", "nal", "nas"):
        want = sorted(n for n in names if q in n.lower())
        assert sorted(r.full_name for r in board.search(board.relevant_postings(index, "ODI"), q).collect()) == want, q


def test_a_search_reads_only_its_trigrams(lake):
    plan = _plan(board.suggestions(lake.board("batsmen"), "batsmen", "ODI", "00012"))
    scan = next(x for x in plan.splitlines() if "FileScan" in x)
    assert "In(gram" in scan and "PartitionFilters: [isnotnull(format" in scan

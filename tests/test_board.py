"""Board computations on literal rows."""

from scorelake.operators import board
from scorelake.specs import spec


def _rows(spark, role, rows):
    s = spec(role)
    schema = ", ".join(f"`{n}` {t}" for n, t in s.silver)
    silver = spark.createDataFrame([tuple(r.get(n) for n in s.silver_names) for r in rows], schema)
    return board.board_rows(silver, role)


BAT = [
    dict(full_name="Ann", country="India", Runs=100, average=50.0, hundreds=1, format="Test", highest_score=90),
    dict(full_name="Ann", country="India", Runs=300, average=30.0, format="ODI"),
    dict(full_name="Bob", country="Australia", Runs=200, average=40.0, format="Test", highest_score=120),
    dict(full_name="Cy", country="Sri Lanka", Runs=None, average=None, format="Test"),
    dict(full_name="Dee", country="Pakistan", Runs=200, average=0.0, format="Test", number_of_sixes=3),
]


def test_default_and_rival(spark):
    rows = _rows(spark, "batsmen", BAT)
    got = {r.slot: r.full_name for r in board.default_and_rival(rows, "batsmen", "Test").collect()}
    # Bob and Dee tie on 200 runs: the tie breaks by name
    assert got == {"player": "Bob", "rival": "Dee"}


def test_rival_falls_back_to_player(spark):
    rows = _rows(spark, "batsmen", BAT[:1])
    got = {r.slot: r.full_name for r in board.default_and_rival(rows, "batsmen", "Test").collect()}
    assert got == {"player": "Ann", "rival": "Ann"}


def test_leaderboard_drops_empty_and_ranks(spark):
    rows = _rows(spark, "batsmen", BAT)
    got = [(r.rank, r.full_name, r.value) for r in
           board.leaderboard(rows, "batsmen", "Test", "runs").collect()]
    assert got == [(1, "Bob", 200.0), (2, "Dee", 200.0), (3, "Ann", 100.0)]


def test_bowling_rates_ascend_zero_last(spark):
    rows = _rows(spark, "bowler", [
        dict(full_name="A", country="India", economy=5.0, format="ODI"),
        dict(full_name="B", country="India", economy=0.0, format="ODI"),
        dict(full_name="C", country="India", economy=4.0, format="ODI"),
        dict(full_name="D", country="India", economy=None, format="ODI"),
    ])
    got = [r.full_name for r in board.leaderboard(rows, "bowler", "ODI", "economy").collect()]
    assert got == ["C", "A", "B"]  # no value (D) is dropped; 0 goes last


def test_metric_kinds(spark):
    rows = _rows(spark, "bowler", [
        dict(full_name="A", country="India", BBI="3/20", wickets=5, average=20.0, format="T20"),
        dict(full_name="A", country="India", BBI="4/10", wickets=7, average=30.0, format="ODI"),
        dict(full_name="A", country="India", BBM="9/99", wickets=1, format="Test"),
    ])
    from pyspark.sql import functions as F
    r = rows.agg(board.metric_agg("best_innings").alias("bi"), board.metric_agg("wickets").alias("w"),
                 board.metric_agg("average").alias("a"), board.metric_agg("best_match").alias("bm"),
                 F.lit(1)).collect()[0]
    assert (r.bi, r.w, r.a, r.bm) == ("4/10", 13, 25.0, "9/99")  # first = ODI before T20


def test_format_bars_all_formats(spark):
    rows = _rows(spark, "batsmen", BAT)
    got = {r.format: (r.position, r.value, r.pct) for r in
           board.format_bars(rows, "batsmen", "Test", "Ann").collect()}
    assert got == {"Test": (1, 100.0, 100.0 / 300.0 * 100), "ODI": (2, 300.0, 100.0), "T20": (3, None, 2.0)}


def test_versus_tie_goes_to_second(spark):
    rows = _rows(spark, "batsmen", BAT)
    got = {r.metric: r for r in board.versus(rows, "batsmen", "Test", "Bob", "Dee").collect()}
    assert got["runs"].first == got["runs"].second == 200.0 and not got["runs"].first_wins
    assert got["average"].first_wins and got["average"].second_pct == 5.0
    assert list(got)[:2] == ["runs", "average"]


def test_availability_and_kpis(spark):
    rows = _rows(spark, "batsmen", BAT)
    avail = {r.metric: r.available for r in board.metric_availability(rows, "batsmen").collect()}
    assert avail["sixes"] and not avail["strike_rate"] and not avail["fifties"]
    k = {r.metric: r.value for r in board.kpis(rows, "batsmen", "Test", "Ann").collect()}
    assert k == {"runs": 100.0, "average": 50.0, "hundreds": 1.0}


def test_best_format_ties_prefer_test(spark):
    rows = _rows(spark, "batsmen", [
        dict(full_name="E", country="India", Runs=50, format="ODI"),
        dict(full_name="E", country="India", Runs=50, format="Test"),
    ])
    r = board.best_format(rows, "batsmen", "Test", "E", scope="all").collect()[0]
    assert (r.best_format, r.value) == ("Test", 50.0)
    r = board.best_format(rows, "batsmen", "ODI", "E", scope="format").collect()[0]
    assert r.best_format == "ODI"


def test_suggestions_case_insensitive(spark):
    rows = _rows(spark, "batsmen", BAT)
    got = [r.full_name for r in board.suggestions(rows, "batsmen", "Test", "AN").collect()]
    assert got == ["Ann"]
    got = [r.full_name for r in board.suggestions(rows, "batsmen", "Test", "",
                                                    exclude_selected=True).collect()]
    assert got[0] == "Dee" and "Bob" not in got


def test_header_and_count(spark):
    rows = _rows(spark, "batsmen", BAT)
    h = board.player_header(rows, "batsmen", "Test", "Ann", scope="all").collect()[0]
    assert h.countries == ["India"] and h.formats == ["Test", "ODI"]
    assert board.player_count(rows).collect()[0].player_count == 4


def test_format_ranking_top(spark):
    rows = _rows(spark, "batsmen", BAT)
    got = [r.full_name for r in board.format_ranking(rows, "batsmen", "Test", top=2).collect()]
    assert got == ["Bob", "Dee"]


def test_suggestions_trim_the_query(spark):
    rows = _rows(spark, "batsmen", BAT)
    trimmed = board.suggestions(rows, "batsmen", "Test", "an").collect()
    assert trimmed and board.suggestions(rows, "batsmen", "Test", "  AN ").collect() == trimmed

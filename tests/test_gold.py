"""Gold aggregates on literal silver rows: NULLs, positive means, constants."""

from scorelake.operators import gold
from scorelake.specs import spec


def _silver(spark, role, rows):
    s = spec(role)
    schema = ", ".join(f"`{n}` {t}" for n, t in s.silver)
    full = []
    for r in rows:
        full.append(tuple(r.get(n) for n in s.silver_names))
    return spark.createDataFrame(full, schema)


def test_player_batting_positive_mean_and_list(spark):
    df = _silver(spark, "batsmen", [
        dict(full_name="A", country="India", Runs=10, matches_played=2, average=40.0, format="ODI"),
        dict(full_name="A", country="India", Runs=5, matches_played=1, average=0.0, format="Test"),
        dict(full_name="A", country="India", Runs=None, matches_played=1, average=None, format="ODI"),
        dict(full_name="B", country="India", Runs=None, matches_played=1, average=0.0, format="T20"),
    ])
    out = {r.full_name: r for r in
           gold.player_all_formats(gold.union_stats(df, "batsmen"), "batsmen").collect()}
    a, b = out["A"], out["B"]
    assert a.formats_played == 3 and a.format_list == ["ODI", "ODI", "Test"]
    assert a.total_runs == 15 and a.total_matches == 4
    assert a.total_average == 40.0  # zero and NULL averages are left out
    assert b.total_average is None and b.total_runs is None  # no positive value; all-NULL sum


def test_country_test_constants(spark):
    df = _silver(spark, "batsmen", [
        dict(full_name="A", country="India", Runs=10, strike_rate=None, balls_faced=None, format="Test"),
        dict(full_name="B", country="India", Runs=20, strike_rate=120.0, balls_faced=50, format="ODI"),
    ])
    out = {r.format: r for r in gold.country_wise(df, "batsmen").collect()}
    assert out["Test"].average_strike_rate == 0.0 and out["Test"].total_balls_faced is None
    assert out["ODI"].average_strike_rate == 120.0 and out["ODI"].total_balls_faced == 50


def test_country_bowling_rounding(spark):
    df = _silver(spark, "bowler", [
        dict(full_name="A", country="India", strike_rate=30.5, economy=4.125, four_wicket_hauls=1, format="ODI"),
        dict(full_name="B", country="India", strike_rate=31.0, economy=4.13, four_wicket_hauls=2, format="ODI"),
        dict(full_name="C", country="India", strike_rate=31.0, four_wicket_hauls=9, format="Test"),
    ])
    out = {r.format: r for r in gold.country_wise(df, "bowler").collect()}
    assert out["ODI"].average_strike_rate == 31.0  # 30.75 -> 0 dp
    assert out["ODI"].total_four_wicket_houls == 3
    assert out["Test"].total_four_wicket_houls == 0  # sum(0) in Test


def test_country_sums_equal_silver_sums(smoke_cards):
    from pyspark.sql import functions as F
    s = smoke_cards.silver("fielder")
    cw = smoke_cards.country_table("fielder")
    a = s.agg(F.sum("catches")).collect()[0][0]
    b = cw.agg(F.sum("total_catches")).collect()[0][0]
    assert a == b


def test_formats_played_is_list_size(smoke_cards):
    from pyspark.sql import functions as F
    t = smoke_cards.player_table("bowler")
    assert t.where(F.size("format_list") != F.col("formats_played")).count() == 0


def test_union_count_is_sum_of_parts(smoke_cards):
    from pyspark.sql import functions as F
    u = smoke_cards.union("batsmen")
    parts = sum(smoke_cards.silver("batsmen").where(F.col("format") == f).count()
                for f in ("ODI", "T20", "Test"))
    assert u.count() == parts


def test_distinct_is_idempotent(smoke_cards):
    s = smoke_cards.silver("bowler")
    assert s.distinct().count() == s.count()

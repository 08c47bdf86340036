"""Gold layer: all-format unions (U1-U3) and aggregate tables.

* U1-U3 ``{role}_stats``: the role's common columns over all formats.  The
  silver role dataset already holds all formats, so this is a projection.
* G1-G9 ``{fmt}_{role}_stats_country_wise``: one ``groupBy(country, format)``
  per role computes all three formats at once; the per-format tables are
  format filters of it (partition pruning once it is stored partitioned
  by format).  There are few countries, so after the partial (map-side)
  aggregation every task ships at most a few dozen rows to the shuffle.
* G10-G12 ``player_stats_all_formats_{role}``: ``groupBy(full_name,
  country)``.  Every aggregate is partial-aggregable with a fixed-size
  buffer; the sorted ``format_list`` is rebuilt from per-format counts
  instead of collecting a list per group, so a hot group costs nothing
  extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions.scalars import round_half_up
from scorelake.specs import FORMATS, check_format, spec


def union_stats(silver: DataFrame, role: str) -> DataFrame:
    """``batsmen_stats`` / ``bowler_stats`` / ``fielder_stats``."""
    return silver.select(*[F.col(f"`{c}`") for c in spec(role).union_columns])


def _is_test() -> Column:
    return F.col("format") == "Test"


def _country_aggs(role: str) -> list[Column]:
    n = F.count("full_name").alias("number_of_players")
    if role == "batsmen":
        return [
            n,
            F.sum("Runs").alias("total_runs"),
            round_half_up(F.avg("average")).alias("average_batting_average"),
            # the Test table has no strike rate: constant 0 (kept as the source)
            F.when(_is_test(), F.lit(0.0))
            .otherwise(round_half_up(F.avg("strike_rate")))
            .alias("average_strike_rate"),
            F.sum("hundreds").alias("total_hundreds"),
            F.sum("fifties").alias("total_fifties"),
            F.sum("ducks").alias("total_ducks"),
            F.when(_is_test(), F.lit(None).cast("bigint"))
            .otherwise(F.sum("balls_faced"))
            .alias("total_balls_faced"),
        ]
    if role == "bowler":
        return [
            n,
            F.sum("wickets").alias("total_wickets"),
            F.sum("Runs").alias("runs_conceded"),
            round_half_up(F.avg("average")).alias("average_bowling_average"),
            round_half_up(F.avg("strike_rate"), 0).alias("average_strike_rate"),
            round_half_up(F.avg("economy")).alias("average_economy"),
            # spelling "houls" kept; Test has no four-wicket column: sum(0)
            F.when(_is_test(), F.lit(0).cast("bigint"))
            .otherwise(F.sum("four_wicket_hauls"))
            .alias("total_four_wicket_houls"),
            F.sum("five_wicket_hauls").alias("total_five_wicket_hauls"),
        ]
    return [
        n,
        F.sum("dismissals").alias("total_dismissals"),
        F.sum("catches").alias("total_catches"),
        F.sum("stumpings").alias("total_stumpings"),
    ]


def country_wise(silver: DataFrame, role: str) -> DataFrame:
    """G1-G9 for one role, all formats: one row per (country, format)."""
    spec(role)
    return silver.groupBy("country", "format").agg(*_country_aggs(role))


def country_wise_format(table: DataFrame, fmt: str) -> DataFrame:
    """One per-format country table (G1..G9) out of ``country_wise``."""
    return table.where(F.col("format") == check_format(fmt, allow_all=False))


def positive_mean(c: str) -> Column:
    """Mean of the positive values only; none positive -> NULL; 2 dp."""
    return round_half_up(F.avg(F.when(F.col(c) > 0, F.col(c))))


def format_list(formats: tuple[str, ...] = FORMATS) -> Column:
    """Sorted list of the group's formats, one entry per row (array_agg).

    Built from one counter per format, so the aggregation buffer has a
    fixed size whatever the group's row count; the value itself has an entry
    per row of the group, as the source's has.
    """
    parts = [
        F.array_repeat(F.lit(f), F.sum(F.when(F.col("format") == f, 1).otherwise(0)).cast("int"))
        for f in sorted(formats)
    ]
    return F.concat(*parts)


def _player_aggs(role: str) -> list[Column]:
    head = [F.count("format").alias("formats_played"), format_list().alias("format_list")]
    if role == "batsmen":
        return head + [
            F.max("years_active").alias("max_career_span"),
            F.sum("Runs").alias("total_runs"),
            F.sum("matches_played").alias("total_matches"),
            F.sum("not_outs").alias("total_not_outs"),
            F.sum("hundreds").alias("total_centuries"),
            F.sum("fifties").alias("total_fifties"),
            F.sum("ducks").alias("total_ducks"),
            positive_mean("average").alias("total_average"),
        ]
    if role == "bowler":
        return head + [
            F.sum("matches_played").alias("total_matches"),
            F.sum("wickets").alias("total_wickets"),
            F.sum("Runs").alias("total_runs_conceded"),
            positive_mean("average").alias("average_bowling_average"),
            positive_mean("economy").alias("average_bowling_economy"),
            positive_mean("strike_rate").alias("average_bowling_strike_rate"),
        ]
    return head + [
        F.sum("catches").alias("total_catches"),
        F.sum("catch_wickets").alias("total_wicket_keeper_catches"),
        F.sum("stumpings").alias("total_stumpings"),
    ]


def player_all_formats(union: DataFrame, role: str) -> DataFrame:
    """One row per (full_name, country) over all formats."""
    spec(role)
    return union.groupBy("full_name", "country").agg(*_player_aggs(role))

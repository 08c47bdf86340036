"""Serving queries (P1-P7, G13-G15, T1-T4, S10), each a lazy DataFrame.

These are the fixed queries of the serving API: player lists per (role,
format), rankings per role and country statistics per (role, format) with
an optional country filter.  Arguments are checked before any plan is
built (P6).  Nothing is collected: the caller decides what to do with the
frame (``show``, ``write``, ``toLocalIterator``, ``json_records``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.functions.scalars import round_half_up
from scorelake.specs import ALL, COUNTRIES, check_format, spec

# Per-format country columns (batting drops total_balls_faced)
COUNTRY_COLUMNS = {
    "batsmen": ("country", "format", "number_of_players", "total_runs",
                "average_batting_average", "average_strike_rate", "total_hundreds",
                "total_fifties", "total_ducks"),
    "bowler": ("country", "format", "number_of_players", "total_wickets", "runs_conceded",
               "average_bowling_average", "average_strike_rate", "average_economy",
               "total_four_wicket_houls", "total_five_wicket_hauls"),
    "fielder": ("country", "format", "number_of_players", "total_dismissals", "total_catches",
                "total_stumpings"),
}
# Columns of the "All" rollup that are means of per-format means
_MEAN_OF_MEANS = ("average_batting_average", "average_strike_rate", "average_bowling_average",
                  "average_economy")

# Ranking keys (descending; NULLs first as in the source database)
RANKING_KEYS = {
    "batsmen": ("total_runs", "total_matches"),
    "bowler": ("total_wickets", "total_matches"),
    "fielder": ("total_catches", "total_wicket_keeper_catches", "total_stumpings"),
}


def players(silver: DataFrame, role: str, fmt: str = ALL) -> DataFrame:
    """A role's player rows for one format, or all of them."""
    s = spec(role)
    check_format(fmt)
    rows = silver if fmt == ALL else silver.where(F.col("format") == fmt)
    return rows.select(*[F.col(f"`{src}`").alias(out) for src, out in s.serve[fmt]])


def country_stats(country_table: DataFrame, role: str, fmt: str = ALL,
                  country: str | None = None) -> DataFrame:
    """Country statistics of a role.

    ``country_table`` is the role's all-format country table (G1-G9 as one
    frame).  A format picks its rows; ``All`` rolls the three formats up per
    country: sums of sums and the rounded mean of the per-format rounded
    means (kept as the source computes it).  The optional country filter is
    applied on top; Catalyst moves it below the aggregate since country is
    the grouping key, and from there into the scan.
    """
    spec(role)
    check_format(fmt)
    cols = COUNTRY_COLUMNS[role]
    if fmt == ALL:
        aggs = []
        for c in cols[2:]:
            if c in _MEAN_OF_MEANS:
                aggs.append(round_half_up(F.avg(c)).alias(c))
            else:
                aggs.append(F.sum(c).alias(c))
        out = (country_table.groupBy("country").agg(*aggs)
               .select("country", F.lit(ALL).alias("format"), *cols[2:]))
    else:
        out = country_table.where(F.col("format") == fmt).select(*cols)
    if country:
        out = out.where(F.col("country") == F.lit(country))
    return out


def rankings(player_table: DataFrame, role: str) -> DataFrame:
    """The all-format player table in ranking order (NULLs first)."""
    return player_table.orderBy(*ranking_order(role))


def ranking_order(role: str) -> list[Column]:
    keys = RANKING_KEYS[spec(role).name]
    return [*[F.col(k).desc_nulls_first() for k in keys], F.col("full_name"), F.col("country")]


def countries(spark: SparkSession) -> DataFrame:
    """The sorted, de-duplicated country names of the code map."""
    return spark.createDataFrame([(c,) for c in COUNTRIES], "country string").orderBy("country")


def json_records(df: DataFrame) -> DataFrame:
    """One JSON object per row, every key (NULL as null); decimals are written as floats."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() == "decimal":
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("json"))

"""The serving queries as SQL table functions.

``register(cards)`` gives the session

* ``players(role, fmt)``
* ``country_stats(role, fmt)``, ``fmt`` one of the formats or 'All'
* ``rankings(role)``, with its position where the lake stores one

for use as ``SELECT ... FROM country_stats('batsmen', 'All') WHERE country = 'India'``.
A function has one set of columns, so the columns of all roles stand side by
side and those of other roles are NULL. Bodies are filters over one view whose
branches carry the role (and 'All') as literals: with literal arguments
Catalyst folds the other branches away, and filters reach the stored files as
they do from the Python functions. A role or format that does not exist raises.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.operators import board, serve
from scorelake.plans.layers import Scorecards
from scorelake.specs import ALL, FORMATS, ROLES

_PREFIX = "scorelake_all_"


def _side_by_side(frames: dict[str, DataFrame]) -> DataFrame:
    tagged = [df.withColumn("of_role", F.lit(role)) for role, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def _define(spark: SparkSession, name: str, df: DataFrame, formats: bool, condition: str) -> None:
    df.createOrReplaceTempView(_PREFIX + name)
    shown = [f for f in df.schema.fields if f.name != "of_role"]
    columns = ", ".join(f"`{f.name}`" for f in shown)
    returns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shown)
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in shown[1:])
    roles = ", ".join(f"'{r}'" for r in ROLES)
    known = f"coalesce({name}.role IN ({roles}), false)"
    if formats:
        known += " AND coalesce({}.fmt IN ({}), false)".format(name, ", ".join(f"'{f}'" for f in (*FORMATS, ALL)))
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(role STRING{', fmt STRING' if formats else ''})
        RETURNS TABLE ({returns})
        RETURN SELECT {columns} FROM {_PREFIX}{name} t WHERE t.of_role = {name}.role{condition}
        UNION ALL
        SELECT CAST(raise_error('invalid role or format; roles: {", ".join(ROLES)}; formats: {", ".join((*FORMATS, ALL))}')
          AS {shown[0].dataType.simpleString()}), {nothing} WHERE NOT ({known})""")


def register(cards: Scorecards, roles=ROLES) -> list[str]:
    """Define the functions in the session of ``cards``; returns their names."""
    spark = cards.spark
    players = {r: board.board_rows(cards.silver(r), r).drop("role") for r in roles}
    _define(spark, "players", _side_by_side(players), True, f" AND (players.fmt = '{ALL}' OR t.format = players.fmt)")
    # 'All' as a literal, so that a format's query does not open the rollup
    stats = {r: cards.country_table(r).select(*serve.COUNTRY_COLUMNS[r]).union(
        cards.country_stats(r, ALL).withColumn("format", F.lit(ALL)).select(*serve.COUNTRY_COLUMNS[r])) for r in roles}
    _define(spark, "country_stats", _side_by_side(stats), True, " AND t.format = country_stats.fmt")
    ranked = {r: cards.stored_ranking(r) if cards.stored(r) else cards.player_table(r) for r in roles}
    _define(spark, "rankings", _side_by_side(ranked), False, "")
    return ["players", "country_stats", "rankings"]

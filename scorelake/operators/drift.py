"""Which raw columns still hold what the silver contract expects.

Raw columns are text and silver casts leniently, so text of another shape turns
into NULL without a word. The report says, per format and raw column, the kind
of text that was seen and how many values the cleaning loses. Every figure is a
count, a maximum or a minimum, so one aggregation with small buffers gives all
columns, whatever the number of rows, and reports of parts can be merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions.names import has_known_code, team_code_of
from scorelake.operators.clean import _raw_name, _typed
from scorelake.specs import spec

#: Kinds of text, each wider than the one before.
KINDS = ("empty", "int", "decimal", "text")


def _filled(raw: Column) -> Column:
    """Whether a cell holds a value: blanks and ``-`` mark a missing one."""
    return F.coalesce(~F.trim(raw).isin("", "-"), F.lit(False))


def _kind(raw: Column) -> Column:
    text = F.trim(raw)
    return (F.when(~_filled(raw), 0).when(text.rlike(r"^[+-]?[0-9]+$"), 1)
            .when(text.rlike(r"^[+-]?[0-9]+\.[0-9]+$"), 2).otherwise(3))


def type_report(raw: DataFrame, role: str) -> DataFrame:
    """Per format and raw column: raw_column, silver_column, contract, kind, filled, unfit, example.

    ``unfit`` counts values that the cleaning turns into NULL (of Player: rows of unknown teams, which it drops) and
    ``example`` is the smallest of them. A column that the frame lacks is ``empty``."""
    s = spec(role)
    have = set(raw.columns) - set(s.dropped)
    columns = [("Player", "full_name", "string")] + [
        (_raw_name(s, name), name, kind) for name, kind in s.silver if name not in ("full_name", "country", "format")]
    aggs = []
    for at, (source, name, kind) in enumerate(columns):
        cell = F.col(f"`{source}`") if source in have else F.lit(None).cast("string")
        fits = (has_known_code(team_code_of(cell)) if source == "Player" and source in have
                else _typed(s, have, name, kind).isNotNull())
        lost = _filled(cell) & ~F.coalesce(fits, F.lit(False))
        aggs.append(F.struct(
            F.lit(source).alias("raw_column"), F.lit(name).alias("silver_column"), F.lit(kind).alias("contract"),
            F.element_at(F.array(*map(F.lit, KINDS)), F.max(_kind(cell)) + 1).alias("kind"),
            F.count(F.when(_filled(cell), 1)).alias("filled"), F.count(F.when(lost, 1)).alias("unfit"),
            F.min(F.when(lost, cell)).alias("example")).alias(f"c{at}"))
    wide = raw.groupBy("format").agg(*aggs)
    return wide.select("format", F.inline(F.array(*[F.col(f"c{at}") for at in range(len(columns))])))


def drifted(raw: DataFrame, role: str, most: float = 0.0) -> DataFrame:
    """The rows of the report whose share of unfit values is above ``most``."""
    return type_report(raw, role).where(F.col("unfit") > most * F.col("filled"))

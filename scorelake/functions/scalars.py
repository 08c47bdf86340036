"""Scalar cleaning functions (C8-C10, C13) and decimal rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_cast(c: Column, to: str) -> Column:
    """Lenient cast; text that does not parse becomes NULL ('-' too)."""
    return c.try_cast(to)


def highest_score_text(hs: Column) -> Column:
    """A not-out score ``200*`` loses its last character.

    The source drops the last character whenever a ``*`` occurs anywhere,
    which is kept as is; the caller casts the result leniently.
    """
    return F.when(hs.contains("*"), hs.substr(F.lit(1), F.length(hs) - 1)).otherwise(hs)


def span_years(span: Column) -> Column:
    """``1989-2012`` -> 23 (end minus start); malformed -> NULL.

    ``get`` (not ``[i]``) so that a span without a dash gives NULL under ANSI.
    """
    parts = F.split(span, "-")
    return F.get(parts, 1).try_cast("int") - F.get(parts, 0).try_cast("int")


def balls_from_overs(overs: Column) -> Column:
    """``12.3`` -> 12*6+3 balls; text without a dot -> 0; NULL stays NULL."""
    parts = F.split(overs, r"\.")
    balls = F.get(parts, 0).try_cast("int") * 6 + F.get(parts, 1).try_cast("int")
    return F.when(overs.contains("."), balls).when(overs.isNotNull(), F.lit(0))


def round_half_up(c: Column, scale: int = 2) -> Column:
    """Round like SQL NUMERIC: half away from zero on the decimal value.

    The value goes through DECIMAL(38,10) first, so a double that prints as a
    tie (1.015) rounds as the tie it stands for, not as its binary neighbour.
    """
    return F.round(c.cast("decimal(38,10)"), scale).cast("double")

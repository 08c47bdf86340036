"""Silver cleaning of raw scorecard frames.

Input is a *role frame*: the raw text columns of one role for any number of
formats, tagged with a ``format`` column (a column a format lacks is NULL in
that format's rows).  That is the shape of the bronze lake, so one scan and
one de-duplication shuffle serve all three formats of a role.

The whole of cleaning is one projection of native expressions, a filter and
a ``distinct``; no Python runs per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions.names import country_of, full_name_of, has_known_code, team_code_of
from scorelake.functions.scalars import (
    balls_from_overs,
    highest_score_text,
    safe_cast,
    span_years,
)
from scorelake.specs import FORMATS, RoleSpec, check_format, spec

_CODE = "__team_code"


def index_columns(columns: list[str]) -> list[str]:
    """Spreadsheet index columns: ``Unnamed: N`` and a blank header.

    Spark names a blank CSV header ``_c0`` (``_cN`` for position N); these
    are dropped by name, every one of them, instead of by position.
    """
    return [c for c in columns if "Unnamed" in c or (c.startswith("_c") and c[2:].isdigit())]


def _raw_name(s: RoleSpec, silver_name: str) -> str:
    for raw, target in s.renames.items():
        if target == silver_name:
            return raw
    return silver_name


def _typed(s: RoleSpec, raw_cols: set[str], name: str, typ: str) -> Column:
    raw = _raw_name(s, name)
    if raw not in raw_cols:  # C15: column presence is decided at plan time
        return F.lit(None).cast(typ).alias(name)
    c = F.col(f"`{raw}`")
    if name == "years_active":
        out = span_years(c)
    elif name == "highest_score":
        out = safe_cast(highest_score_text(c), "int")
    elif name == "Overs":
        out = balls_from_overs(c)
    elif typ == "string":
        out = c
    else:
        out = safe_cast(c, typ)
    return out.alias(name)


def clean(raw: DataFrame, role: str, dedup: bool = True) -> DataFrame:
    """Raw role frame -> silver rows of that role (all formats in ``raw``)."""
    s = spec(role)
    cols = [c for c in raw.columns if c not in index_columns(raw.columns)]
    present = set(cols) - set(s.dropped)
    if "Player" not in present or "format" not in present:
        raise ValueError("a role frame needs the columns Player and format")
    player = F.col("Player")
    typed = [
        _typed(s, present, name, typ)
        for name, typ in s.silver
        if name not in ("full_name", "country", "format")
    ]
    parsed = raw.select(
        full_name_of(player).alias("full_name"),
        team_code_of(player).alias(_CODE),
        *typed,
        F.col("format"),
    )
    # Unknown teams are dropped (tested on the code, see has_known_code)
    known = parsed.where(has_known_code(F.col(_CODE)))
    out = known.select(
        "full_name",
        country_of(F.col(_CODE)).alias("country"),
        *[F.col(f"`{name}`") for name, _ in s.silver if name not in ("full_name", "country")],
    )
    return out.distinct() if dedup else out  # C14


def tag_format(df: DataFrame, fmt: str) -> DataFrame:
    """C11: tag one per-format frame (e.g. one CSV file) with its format."""
    return df.withColumn("format", F.lit(check_format(fmt, allow_all=False)))


def role_frame(frames: dict[str, DataFrame]) -> DataFrame:
    """Union per-format raw frames of one role into a role frame.

    Columns a format lacks become NULL (``allowMissingColumns``); every
    frame must already carry its ``format`` tag or gets it from the key.
    """
    tagged = [
        df if "format" in df.columns else tag_format(df, fmt)
        for fmt, df in frames.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def clean_format(raw_one_format: DataFrame, role: str, fmt: str) -> DataFrame:
    """Clean a single per-format frame, keeping only that format's columns."""
    s = spec(role)
    silver = clean(tag_format(raw_one_format, fmt), role)
    keep = [n for n in s.silver_names if _available(s, n, fmt)]
    return silver.select(*[F.col(f"`{n}`") for n in keep])


def _available(s: RoleSpec, silver_name: str, fmt: str) -> bool:
    if silver_name in ("full_name", "country", "format"):
        return True
    return _raw_name(s, silver_name) in s.raw_by_format[fmt]


def format_columns(role: str, fmt: str) -> list[str]:
    """Silver columns that exist for one (role, format) table (DDL shape)."""
    s = spec(role)
    return [n for n in s.silver_names if _available(s, n, fmt)]


__all__ = ["clean", "clean_format", "format_columns", "index_columns", "role_frame",
           "tag_format", "FORMATS"]

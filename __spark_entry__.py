"""

Every query derives raw scorecards from the driver's tables (see
``scorelake.sources.fixture``), cleans them and answers one operator of the
inventory; ``oracle_sql`` holds the same computation as DuckDB SQL.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# importable when the driver loads this file by path
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle import sql as O
from oracle.fixed import (
    BOARD_FORMAT_ORDER, COUNTRY_COLUMNS, COUNTRY_VIEW_COLUMNS, FIRST_METRICS, FORMATS, MEAN_METRICS, RANKING_VIEW_COLUMNS,
    ROLES, spec,
)
from scorelake.functions.names import country_of, full_name_of, team_code_of
from scorelake.functions.scalars import balls_from_overs, highest_score_text, safe_cast, span_years
from scorelake.operators import board, drift, serve
from scorelake.plans.layers import Scorecards
from scorelake.sources import fixture

SMOKE_DIR = "/root/testdata/sf0.001"

_SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _reg(name: str, sql: str | None = None):
    def deco(fn):
        _SPARK[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def _sc(spark: SparkSession, d: str) -> Scorecards:
    return Scorecards.from_fixture(spark, d)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: all-format batting table (G10) in ranking order."""
    return _sc(spark, SMOKE_DIR).rankings("batsmen")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_SPARK)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# =============================================================== cleaning (C*)
for _role in ROLES:
    _reg(f"clean_{_role}", O.with_roles(f"SELECT * FROM silver_{_role}", [_role]))(
        lambda spark, d, r=_role: _sc(spark, d).silver(r))


@_reg("parse_player", O.with_roles(
    "SELECT DISTINCT Player, "
    "array_to_string(list_filter(string_split(Player, ' '), lambda t: NOT contains(t, '(')), ' ') AS full_name, "
    "code AS team_code, " + O.country_case("code") + " AS country FROM c_batsmen", ["batsmen"]))
def _parse_player(spark, d):
    raw = _sc(spark, d).raw("batsmen").select("Player").distinct()
    p = F.col("Player")
    return raw.select("Player", full_name_of(p).alias("full_name"),
                      team_code_of(p).alias("team_code")).select(
        "*", country_of(F.col("team_code")).alias("country"))


@_reg("highest_score", O.with_roles(
    "SELECT Player, format, HS, " + O._typed("batsmen", "highest_score", "int").replace(
        ' AS "highest_score"', "") + " AS highest_score FROM raw_batsmen", ["batsmen"], silver=False))
def _highest_score(spark, d):
    raw = _sc(spark, d).raw("batsmen")
    return raw.select("Player", "format", "HS",
                      safe_cast(highest_score_text(F.col("HS")), "int").alias("highest_score"))


@_reg("span_years", O.with_roles(
    "SELECT Player, format, Span, " + O._typed("fielder", "years_active", "int").replace(
        ' AS "years_active"', "") + " AS years_active FROM raw_fielder", ["fielder"], silver=False))
def _span_years(spark, d):
    raw = _sc(spark, d).raw("fielder")
    return raw.select("Player", "format", "Span", span_years(F.col("Span")).alias("years_active"))


@_reg("overs_to_balls", O.with_roles(
    "SELECT Player, Overs, " + O._typed("bowler", "Overs", "int").replace(' AS "Overs"', "")
    + " AS balls FROM raw_bowler WHERE format = 'T20'", ["bowler"], silver=False))
def _overs(spark, d):
    raw = _sc(spark, d).raw("bowler").where(F.col("format") == "T20")
    return raw.select("Player", "Overs", balls_from_overs(F.col("Overs")).alias("balls"))


@_reg("safe_cast", O.with_roles(
    "SELECT Player, format, " + ", ".join([
        O._typed("batsmen", "matches_played", "int"), O._typed("batsmen", "average", "float"),
        O._typed("batsmen", "strike_rate", "float"), O._typed("batsmen", "balls_faced", "int")])
    + " FROM raw_batsmen", ["batsmen"], silver=False))
def _safe_cast(spark, d):
    raw = _sc(spark, d).raw("batsmen")
    return raw.select("Player", "format",
                      safe_cast(F.col("Mat"), "int").alias("matches_played"),
                      safe_cast(F.col("Ave"), "float").alias("average"),
                      safe_cast(F.col("SR"), "float").alias("strike_rate"),
                      safe_cast(F.col("BF"), "int").alias("balls_faced"))


@_reg("dedup_rows", O.with_roles(
    "SELECT a.format, a.n_rows, b.n_distinct FROM "
    "(SELECT format, count(*) AS n_rows FROM raw_fielder GROUP BY format) a JOIN "
    "(SELECT format, count(*) AS n_distinct FROM (SELECT DISTINCT * FROM raw_fielder) GROUP BY format) b "
    "ON a.format = b.format", ["fielder"], silver=False))
def _dedup(spark, d):
    raw = _sc(spark, d).raw("fielder")
    once = raw.groupBy(*[F.col(f"`{c}`") for c in raw.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return once.groupBy("format").agg(F.sum("__n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))


# ============================================================ unions
for _role in ROLES:
    _reg(f"{_role}_stats", O.with_roles(
        f"SELECT {O.union_cols(_role)} FROM silver_{_role}", [_role]))(
        lambda spark, d, r=_role: _sc(spark, d).table(f"{r}_stats"))

# ===================================================== country tables
for _role in ROLES:
    for _fmt in FORMATS:
        _reg(f"country_{_fmt.lower()}_{_role}", O.with_roles(
            f"SELECT * FROM cw_{_role} WHERE format = '{_fmt}'", [_role],
            extra=O.country_wise_cte(_role)))(
            lambda spark, d, r=_role, f=_fmt:
                _sc(spark, d).table(f"{f.lower()}_{r}_stats_country_wise"))

# ====================================================== player tables
for _role in ROLES:
    _reg(f"player_all_{_role}", O.with_roles(
        f"SELECT * FROM pt_{_role}", [_role], extra=O.player_table_cte(_role)))(
        lambda spark, d, r=_role: _sc(spark, d).table(f"player_stats_all_formats_{r}"))


# ==================================================== country "All" (G13-G15)
def _country_all_sql(role: str, country: str | None = None) -> str:
    cols = COUNTRY_COLUMNS[role][2:]
    aggs = []
    for c in cols:
        if c in ("average_batting_average", "average_strike_rate", "average_bowling_average",
                 "average_economy"):
            aggs.append(f"{O.rnd(f'avg({c})')} AS {c}")
        else:
            aggs.append(f"{O.bsum(c)} AS {c}")
    where = f" WHERE country = '{country}'" if country else ""
    return O.with_roles(
        f"SELECT * FROM (SELECT country, 'All' AS format, {', '.join(aggs)} FROM cw_{role} "
        f"GROUP BY country){where}", [role], extra=O.country_wise_cte(role))


for _role in ROLES:
    _reg(f"country_all_{_role}", _country_all_sql(_role))(
        lambda spark, d, r=_role: _sc(spark, d).country_stats(r, "All"))

# ======================================================= player lists
for _role in ROLES:
    for _fmt in FORMATS + ("All",):
        _where = "" if _fmt == "All" else f" WHERE format = '{_fmt}'"
        _reg(f"players_{_role}_{_fmt.lower()}", O.with_roles(
            f"SELECT {O.serve_cols(_role, _fmt)} FROM silver_{_role}{_where}", [_role]))(
            lambda spark, d, r=_role, f=_fmt: _sc(spark, d).players(r, f))

# ===================================================== country lists
for _role in ROLES:
    for _fmt in FORMATS:
        _reg(f"country_list_{_role}_{_fmt.lower()}", O.with_roles(
            f"SELECT {', '.join(COUNTRY_COLUMNS[_role])} FROM cw_{_role} "
            f"WHERE format = '{_fmt}'", [_role], extra=O.country_wise_cte(_role)))(
            lambda spark, d, r=_role, f=_fmt: _sc(spark, d).country_stats(r, f))

_reg("country_filter", O.with_roles(
    f"SELECT {', '.join(COUNTRY_COLUMNS['bowler'])} FROM cw_bowler "
    "WHERE format = 'ODI' AND country = 'Pakistan'", ["bowler"],
    extra=O.country_wise_cte("bowler")))(
    lambda spark, d: _sc(spark, d).country_stats("bowler", "ODI", "Pakistan"))
_reg("country_filter_all", _country_all_sql("batsmen", "India"))(
    lambda spark, d: _sc(spark, d).country_stats("batsmen", "All", "India"))

# ============================================================ rankings
for _role in ROLES:
    _reg(f"rankings_{_role}", O.with_roles(
        f"SELECT * FROM pt_{_role}", [_role], extra=O.player_table_cte(_role)))(
        lambda spark, d, r=_role: _sc(spark, d).rankings(r))


# ==================================================== board (B*, T5-T14)
def _rows_sql(role: str, body: str) -> str:
    return O.with_roles(body, [role], extra=O.board_rows_cte(role))


def _ranked_sql(role: str, fmt: str) -> str:
    """T9 as a subquery: (full_name, value, country)."""
    p = spec(role).primary
    return (f"(SELECT full_name, {O.metric_agg(p)} AS value, min(country) AS country "
            f"FROM rows_{role} WHERE format = '{fmt}' GROUP BY full_name)")


def _pick_sql(role: str, fmt: str, rank: int | str | tuple[str]) -> str:
    """Name at a rank (1-based) of T9; for 2 falls back to rank 1; a name is itself.

    ``(name,)`` is the best other than that name, or the name if nobody else is there.
    """
    if isinstance(rank, str):
        return f"'{rank}'"
    r = _ranked_sql(role, fmt)
    order = f"ORDER BY {O.num('value')} DESC, full_name"
    if isinstance(rank, tuple):
        return (f"(SELECT coalesce((SELECT full_name FROM {r} WHERE full_name <> '{rank[0]}' "
                f"{order} LIMIT 1), '{rank[0]}'))")
    if rank == 1:
        return f"(SELECT full_name FROM {r} {order} LIMIT 1)"
    return (f"(SELECT coalesce((SELECT full_name FROM {r} WHERE full_name <> {_pick_sql(role, fmt, 1)} "
            f"{order} LIMIT 1), {_pick_sql(role, fmt, 1)}))")


_BOARD_FMT = {"batsmen": "Test", "bowler": "ODI", "fielder": "T20"}

for _role in ROLES:
    _fmt = _BOARD_FMT[_role]
    s_ = spec(_role)
    _keys = ", ".join(f"{O.num(O.q(k))} DESC" for k in s_.ranking_sort)
    _rest = ", ".join(f"{O.q(c)} ASC NULLS FIRST" for c in s_.ranking_columns)
    _reg(f"format_ranking_{_role}", _rows_sql(
        _role, f"SELECT {', '.join(O.q(c) for c in s_.ranking_columns)} FROM rows_{_role} "
        f"WHERE format = '{_fmt}' ORDER BY {_keys}, {_rest} LIMIT 25"))(
        lambda spark, d, r=_role, f=_fmt: board.format_ranking(_sc(spark, d).rows(r), r, f))

for _role in ROLES:
    _reg(f"ranking_view_{_role}", O.with_roles(
        f"SELECT {', '.join(RANKING_VIEW_COLUMNS[_role])} FROM pt_{_role}", [_role],
        extra=O.player_table_cte(_role)))(
        lambda spark, d, r=_role: board.ranking_view(_sc(spark, d).rankings(r), r))

_reg("country_sorted", O.with_roles(
    f"SELECT {', '.join(COUNTRY_VIEW_COLUMNS['fielder'])} FROM cw_fielder WHERE format = 'Test'",
    ["fielder"], extra=O.country_wise_cte("fielder")))(
    lambda spark, d: board.country_view(board.country_sorted(
        _sc(spark, d).country_stats("fielder", "Test"), "fielder"), "fielder"))


def _leader_sql(role: str, fmt: str, metric: str, asc: bool, top: int = 12) -> str:
    v = "CAST(value AS DOUBLE)"
    order = (f"CASE WHEN {v} <> 0 THEN {v} END ASC NULLS LAST, full_name" if asc
             else f"{O.num('value')} DESC, full_name")
    inner = (f"SELECT full_name, {O.metric_agg(metric)} AS value, min(country) AS country "
             f"FROM rows_{role} WHERE format = '{fmt}' GROUP BY full_name")
    return _rows_sql(role, (
        f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank, full_name, country, "
        f"CAST(value AS DOUBLE) AS value FROM (SELECT * FROM ({inner}) WHERE value IS NOT NULL "
        f"ORDER BY {order} LIMIT {top})"))


_reg("leaderboard_sum", _leader_sql("batsmen", "T20", "runs", False))(
    lambda spark, d: board.leaderboard(_sc(spark, d).rows("batsmen"), "batsmen", "T20", "runs"))
_reg("leaderboard_rate_asc", _leader_sql("bowler", "ODI", "economy", True))(
    lambda spark, d: board.leaderboard(_sc(spark, d).rows("bowler"), "bowler", "ODI", "economy"))
_reg("leaderboard_rate_desc", _leader_sql("batsmen", "ODI", "average", False))(
    lambda spark, d: board.leaderboard(_sc(spark, d).rows("batsmen"), "batsmen", "ODI",
                                       "average"))
_reg("leaderboard_max", _leader_sql("batsmen", "Test", "highest_score", False))(
    lambda spark, d: board.leaderboard(_sc(spark, d).rows("batsmen"), "batsmen", "Test",
                                       "highest_score"))

_SUGGEST_Q = "MER#0000011"


def _suggest_sql(role: str, fmt: str, query: str, exclude: int | str | None) -> str:
    r = _ranked_sql(role, fmt)
    order = f"{O.num('value')} DESC, full_name"
    ex = f" AND full_name <> {_pick_sql(role, fmt, exclude)}" if exclude else ""
    return _rows_sql(role, (
        f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank, full_name, country, "
        f"CAST(value AS DOUBLE) AS value FROM (SELECT * FROM {r} "
        f"WHERE contains(lower(full_name), '{query.lower()}'){ex} ORDER BY {order} LIMIT 8)"))


_reg("suggestions", _suggest_sql("batsmen", "ODI", _SUGGEST_Q, None))(
    lambda spark, d: board.suggestions(_sc(spark, d).rows("batsmen"), "batsmen", "ODI",
                                       _SUGGEST_Q))
_reg("compare_suggestions", _suggest_sql("batsmen", "ODI", "", 1))(
    lambda spark, d: board.suggestions(_sc(spark, d).rows("batsmen"), "batsmen", "ODI", "",
                                       exclude_selected=True))

_reg("default_and_rival", _rows_sql("bowler", (
    f"SELECT 'player' AS slot, {_pick_sql('bowler', 'Test', 1)} AS full_name UNION ALL "
    f"SELECT 'rival' AS slot, {_pick_sql('bowler', 'Test', 2)} AS full_name")))(
    lambda spark, d: board.default_and_rival(_sc(spark, d).rows("bowler"), "bowler", "Test"))

_reg("player_names", _rows_sql("fielder", (
    "SELECT DISTINCT full_name FROM rows_fielder WHERE format = 'ODI' "
    "AND full_name IS NOT NULL AND full_name <> ''")))(
    lambda spark, d: board.player_names(_sc(spark, d).rows("fielder"), "ODI"))


@_reg("player_count", O.with_roles(
    "SELECT count(DISTINCT full_name) AS player_count FROM (SELECT full_name FROM silver_batsmen "
    "UNION ALL SELECT full_name FROM silver_bowler UNION ALL SELECT full_name FROM silver_fielder)",
    list(ROLES)))
def _player_count(spark, d):
    sc = _sc(spark, d)
    return board.player_count(*[sc.rows(r) for r in ROLES])


def _avail_sql(role: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({i + 1} AS INTEGER) AS position, "
        f"coalesce(bool_or({O.q(m)} IS NOT NULL), false) AS available FROM rows_{role}"
        for i, m in enumerate(spec(role).metrics))
    return _rows_sql(role, parts)


_reg("metric_availability", _avail_sql("batsmen"))(
    lambda spark, d: board.metric_availability(_sc(spark, d).rows("batsmen"), "batsmen"))


def _values_sql(role: str, fmt: str, metrics: tuple[str, ...], picks: dict[str, int | str],
                limit: int | None, carry: str = "") -> str:
    """Available metrics of the role with the picked players' values."""
    text = any(m in FIRST_METRICS for m in metrics)
    rows = []
    pick_cols = ", ".join(f"{_pick_sql(role, fmt, rank)} AS pick_{name}" for name, rank in picks.items())
    src = f"(SELECT * FROM rows_{role}, (SELECT {pick_cols}) AS picks)"
    for i, m in enumerate(metrics):
        vals = []
        for name, rank in picks.items():
            v = O.metric_agg(m, f"format = '{fmt}' AND full_name = pick_{name}")
            if m in FIRST_METRICS:
                pass
            elif text and m not in MEAN_METRICS:
                v = f"CAST(CAST({v} AS BIGINT) AS VARCHAR)"
            else:
                v = f"CAST({v} AS {'VARCHAR' if text else 'DOUBLE'})"
            vals.append(f"{v} AS {name}")
        rows.append(f"SELECT '{m}' AS metric, {i} AS idx, bool_or({O.q(m)} IS NOT NULL) AS available, "
                    f"{', '.join(vals)}{carry} FROM {src}")
    allm = " UNION ALL ".join(rows)
    lim = f" WHERE position <= {limit}" if limit else ""
    names = ", ".join(picks)
    return _rows_sql(role, (
        f"SELECT metric, position, {names}{', country' if carry else ''} FROM ("
        f"SELECT *, CAST(row_number() OVER (ORDER BY idx) AS INTEGER) AS position FROM ({allm}) "
        f"WHERE available){lim}"))


_reg("kpis", _values_sql("batsmen", "Test", spec("batsmen").kpis, {"value": 1}, None))(
    lambda spark, d: board.kpis(_sc(spark, d).rows("batsmen"), "batsmen", "Test"))
_reg("profile", _values_sql("bowler", "Test", spec("bowler").profile, {"value": 1}, None))(
    lambda spark, d: board.profile(_sc(spark, d).rows("bowler"), "bowler", "Test"))


def _versus_sql(role: str, fmt: str, first: int | str = 1, second: int | str = 2) -> str:
    base = _values_sql(role, fmt, spec(role).metrics, {"first": first, "second": second}, 5)
    head, body = base.rsplit("\nSELECT metric, position, first, second FROM (", 1)
    f, s = O.num("first"), O.num("second")
    top = f"greatest({f}, {s}, 1.0)"
    return (f"{head}\nSELECT metric, position, first, second, greatest({f} / {top} * 100, 5.0) AS first_pct, "
            f"greatest({s} / {top} * 100, 5.0) AS second_pct, {f} > {s} AS first_wins FROM ("
            f"SELECT metric, position, first, second FROM ({body})")


_reg("versus", _versus_sql("batsmen", "ODI"))(
    lambda spark, d: board.versus(_sc(spark, d).rows("batsmen"), "batsmen", "ODI"))

_CARD_COUNTRY = (", coalesce(min(CASE WHEN format = '{fmt}' AND full_name = pick_value THEN country END), "
                 "'Unknown country') AS country")
_reg("versus_card", _values_sql(
    "fielder", "ODI", spec("fielder").metrics, {"value": 1}, 4,
    carry=_CARD_COUNTRY.format(fmt="ODI")))(
    lambda spark, d: board.versus_card(_sc(spark, d).rows("fielder"), "fielder", "ODI"))


def _by_format_sql(role: str, fmt: str, first: int | str = 1, second: int | str = 2) -> str:
    p = spec(role).primary
    a, b = _pick_sql(role, fmt, first), _pick_sql(role, fmt, second)
    cols = []
    for i, f in enumerate(BOARD_FORMAT_ORDER):
        ca, cb = f"format = '{f}' AND full_name = {a}", f"format = '{f}' AND full_name = {b}"
        cols.append(f"CAST({O.metric_agg(p, ca)} AS DOUBLE) AS first{i}")
        cols.append(f"CAST({O.metric_agg(p, cb)} AS DOUBLE) AS second{i}")
    top = "greatest(1.0, " + ", ".join(O.num(f"{w}{i}") for w in ("first", "second")
                                       for i in range(3)) + ")"
    unions = " UNION ALL ".join(
        f"SELECT '{f}' AS format, CAST({i + 1} AS INTEGER) AS position, first{i} AS first, "
        f"second{i} AS second, {top} AS top FROM one" for i, f in enumerate(BOARD_FORMAT_ORDER))
    fv, sv = O.num("first"), O.num("second")
    return _rows_sql(role, (
        f", one AS (SELECT {', '.join(cols)} FROM rows_{role})\n"
        f"SELECT format, position, first, second, greatest({fv} / top * 100, 5.0) AS first_pct, "
        f"greatest({sv} / top * 100, 5.0) AS second_pct, {fv} > {sv} AS first_wins FROM ({unions})"
    )).replace(")\n, one AS", "),\none AS", 1)


_reg("versus_by_format", _by_format_sql("bowler", "T20"))(
    lambda spark, d: board.versus_by_format(_sc(spark, d).rows("bowler"), "bowler", "T20"))


def _bars_sql(role: str, fmt: str, pick: int | str = 1) -> str:
    p = spec(role).primary
    a = _pick_sql(role, fmt, pick)
    conds = [f"format = '{f}' AND full_name = {a}" for f in BOARD_FORMAT_ORDER]
    cols = [f"CAST({O.metric_agg(p, c)} AS DOUBLE) AS v{i}" for i, c in enumerate(conds)]
    top = "greatest(1.0, " + ", ".join(O.num(f"v{i}") for i in range(3)) + ")"
    unions = " UNION ALL ".join(
        f"SELECT '{f}' AS format, CAST({i + 1} AS INTEGER) AS position, v{i} AS value, {top} AS top "
        f"FROM one" for i, f in enumerate(BOARD_FORMAT_ORDER))
    return _rows_sql(role, (
        f", one AS (SELECT {', '.join(cols)} FROM rows_{role})\n"
        f"SELECT format, position, value, greatest({O.num('value')} / top * 100, 2.0) AS pct "
        f"FROM ({unions})")).replace(")\n, one AS", "),\none AS", 1)


_reg("format_bars", _bars_sql("batsmen", "ODI"))(
    lambda spark, d: board.format_bars(_sc(spark, d).rows("batsmen"), "batsmen", "ODI"))


def _best_sql(role: str, fmt: str, scope: str, pick: int | str = 1) -> str:
    p = spec(role).primary
    a = _pick_sql(role, fmt, pick)
    where = f"full_name = {a}" + (f" AND format = '{fmt}'" if scope == "format" else "")
    sel = []
    for i, f in enumerate(BOARD_FORMAT_ORDER):
        v = O.metric_agg(p, f"format = '{f}'")
        sel.append(f"SELECT '{f}' AS best_format, {i} AS o, CAST({v} AS DOUBLE) AS value "
                   f"FROM rows_{role} WHERE {where}")
    unions = " UNION ALL ".join(sel)
    return _rows_sql(role, (
        f"SELECT best_format, value FROM ({unions}) ORDER BY {O.num('value')} DESC, o LIMIT 1"))


_reg("best_format", _best_sql("fielder", "Test", "all"))(
    lambda spark, d: board.best_format(_sc(spark, d).rows("fielder"), "fielder", "Test",
                                       scope="all"))
_reg("best_format_current", _best_sql("batsmen", "T20", "format"))(
    lambda spark, d: board.best_format(_sc(spark, d).rows("batsmen"), "batsmen", "T20"))


def _header_sql(role: str, fmt: str, pick: int | str = 1) -> str:
    a = _pick_sql(role, fmt, pick)
    fl = ", ".join(f"CASE WHEN bool_or(format = '{f}') THEN '{f}' END" for f in BOARD_FORMAT_ORDER)
    return _rows_sql(role, (
        f"SELECT min(full_name) AS full_name, "
        f"list_sort(list_distinct(list(CASE WHEN country <> '' THEN country END))) AS countries, "
        f"list_filter([{fl}], lambda x: x IS NOT NULL) AS formats "
        f"FROM rows_{role} WHERE format = '{fmt}' AND full_name = {a}"))


_reg("player_header", _header_sql("batsmen", "Test"))(
    lambda spark, d: board.player_header(_sc(spark, d).rows("batsmen"), "batsmen", "Test"))


def _compare_header_sql(role: str, fmt: str, player: int | str = 1, rival: int | str | tuple[str] = 2) -> str:
    out = []
    for slot, rank in (("player", player), ("rival", rival)):
        p = _pick_sql(role, fmt, rank)
        out.append(f"SELECT '{slot}' AS slot, min(full_name) AS full_name, "
                   f"coalesce(min(country), 'Unknown') AS country FROM rows_{role} "
                   f"WHERE format = '{fmt}' AND full_name = {p}")
    return _rows_sql(role, " UNION ALL ".join(out))


_reg("compare_header", _compare_header_sql("bowler", "ODI"))(
    lambda spark, d: board.compare_header(_sc(spark, d).rows("bowler"), "bowler", "ODI"))


# the other roles of the board queries above
for _role, _fmt in (("batsmen", "T20"), ("bowler", "T20"), ("fielder", "Test")):
    _more = {
        "metric_availability": (_avail_sql(_role),
                                lambda rows, r, f: board.metric_availability(rows, r)),
        "kpis": (_values_sql(_role, _fmt, spec(_role).kpis, {"value": 1}, None), board.kpis),
        "profile": (_values_sql(_role, _fmt, spec(_role).profile, {"value": 1}, None), board.profile),
        "versus": (_versus_sql(_role, _fmt), board.versus),
        "versus_card": (_values_sql(_role, _fmt, spec(_role).metrics, {"value": 1}, 4,
                                    carry=_CARD_COUNTRY.format(fmt=_fmt)), board.versus_card),
        "versus_by_format": (_by_format_sql(_role, _fmt), board.versus_by_format),
        "format_bars": (_bars_sql(_role, _fmt), board.format_bars),
        "leaderboard": (_leader_sql(_role, _fmt, spec(_role).primary, False), board.leaderboard),
    }
    for _name, (_sql, _fn) in _more.items():
        _reg(f"{_name}_{_role}", _sql)(
            lambda spark, d, fn=_fn, r=_role, f=_fmt: fn(_sc(spark, d).rows(r), r, f))

for _role in ("batsmen", "bowler"):
    _reg(f"country_sorted_{_role}", O.with_roles(
        f"SELECT {', '.join(COUNTRY_VIEW_COLUMNS[_role])} FROM cw_{_role} WHERE format = 'T20'",
        [_role], extra=O.country_wise_cte(_role)))(
        lambda spark, d, r=_role: board.country_view(board.country_sorted(
            _sc(spark, d).country_stats(r, "T20"), r), r))

# the same with the player (and the rival) named, as after a click on the board
_P, _Q = "Customer#000000005", "Customer#000000007"
_named = {
    "kpis_named": (_values_sql("batsmen", "ODI", spec("batsmen").kpis, {"value": _P}, None), "batsmen",
                   lambda rows, r: board.kpis(rows, r, "ODI", _P)),
    "profile_named": (_values_sql("bowler", "ODI", spec("bowler").profile, {"value": _P}, None), "bowler",
                      lambda rows, r: board.profile(rows, r, "ODI", _P)),
    "versus_named": (_versus_sql("batsmen", "Test", _P, _Q), "batsmen",
                     lambda rows, r: board.versus(rows, r, "Test", _P, _Q)),
    "versus_by_format_named": (_by_format_sql("fielder", "ODI", _P, _Q), "fielder",
                               lambda rows, r: board.versus_by_format(rows, r, "ODI", _P, _Q)),
    "format_bars_named": (_bars_sql("bowler", "ODI", _P), "bowler",
                          lambda rows, r: board.format_bars(rows, r, "ODI", _P)),
    "best_format_named": (_best_sql("batsmen", "ODI", "all", _P), "batsmen",
                          lambda rows, r: board.best_format(rows, r, "ODI", _P, scope="all")),
    "player_header_named": (_header_sql("fielder", "T20", _P), "fielder",
                            lambda rows, r: board.player_header(rows, r, "T20", _P)),
    "compare_header_named": (_compare_header_sql("batsmen", "Test", _P, _Q), "batsmen",
                             lambda rows, r: board.compare_header(rows, r, "Test", _P, _Q)),
    "compare_header_player": (_compare_header_sql("bowler", "Test", _P, (_P,)), "bowler",
                              lambda rows, r: board.compare_header(rows, r, "Test", _P)),
    "compare_header_rival": (_compare_header_sql("bowler", "T20", 1, _Q), "bowler",
                             lambda rows, r: board.compare_header(rows, r, "T20", rival=_Q)),
    "compare_suggestions_named": (_suggest_sql("fielder", "T20", "", _P), "fielder",
                                  lambda rows, r: board.suggestions(rows, r, "T20", "", exclude=_P)),
}
for _name, (_sql, _role, _fn) in _named.items():
    _reg(_name, _sql)(lambda spark, d, fn=_fn, r=_role: fn(_sc(spark, d).rows(r), r))


@_reg("union_roles", O.with_roles(
    "SELECT role, format, count(*) AS n_rows, count(runs) AS n_runs, count(wickets) AS n_wickets, "
    "count(catches) AS n_catches FROM (" + " UNION ALL BY NAME ".join(
        f"SELECT * FROM rows_{r}" for r in ROLES) + ") GROUP BY role, format", list(ROLES),
    extra=",\n".join(O.board_rows_cte(r) for r in ROLES)))
def _union_roles(spark, d):
    sc = _sc(spark, d)
    u = sc.rows("batsmen")
    for r in ("bowler", "fielder"):
        u = u.unionByName(sc.rows(r), allowMissingColumns=True)
    return u.groupBy("role", "format").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("runs").alias("n_runs"),
        F.count("wickets").alias("n_wickets"), F.count("catches").alias("n_catches"))


# ================================================== sinks (rows-only checks)
@_reg("json_records")
def _json(spark, d):
    return serve.json_records(_sc(spark, d).country_stats("batsmen", "All"))


def _scratch_lake(spark: SparkSession) -> str:
    import uuid
    from scorelake.session import checkpoint_dir
    return f"{checkpoint_dir(spark)}/lake-{uuid.uuid4().hex}"


@_reg("lake_roundtrip", O.with_roles(
    "SELECT * FROM raw_batsmen WHERE format = 'T20'", ["batsmen"], silver=False))
def _lake_roundtrip(spark, d):
    """Bronze write of the raw batting frame and its pruned read-back."""
    from scorelake.sources import lake
    root = _scratch_lake(spark)
    raw = _sc(spark, d).raw("batsmen")
    lake.write_bronze(raw, root, "batsmen")
    return lake.read_bronze(spark, root, "batsmen", "T20").select(*raw.columns)


@_reg("refresh_all", O.with_roles(
    " UNION ALL BY NAME ".join(f"SELECT '{t}_{r}' AS table_name, * FROM {t}_{r}"
                               for r in ROLES for t in ("cw", "pt")), list(ROLES),
    extra=",\n".join(f(r) for r in ROLES for f in (O.country_wise_cte, O.player_table_cte))))
def _refresh_all(spark, d):
    """The whole batch into a lake, then all six stored gold datasets, tagged."""
    from scorelake.plans.refresh import land_fixture, refresh
    root = _scratch_lake(spark)
    refresh(spark, root, raw=land_fixture(spark, d, root))
    cards, out = Scorecards.from_lake(spark, root), None
    for r in ROLES:
        for tag, df in (("cw", cards.country_table(r)), ("pt", cards.player_table(r))):
            df = df.select(F.lit(f"{tag}_{r}").alias("table_name"), "*")
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def _csv_silver(spark, d, role):
    """The raw cards as CSV folders with an index column, read back and cleaned."""
    from scorelake.operators.clean import clean
    from scorelake.sources import lake
    root = _scratch_lake(spark)
    cards = fixture.scorecards(spark, d)
    for fmt in FORMATS:
        raw = fixture.format_raw(cards, role, fmt)
        raw.select(F.lit("0").alias("Unnamed: 0"), "*").write.option("header", True).csv(
            f"{root}/{lake.RAW_FILES[(role, fmt)]}")
    return clean(lake.read_raw_role(spark, root, role), role)


for _role in ROLES:
    _reg(f"csv_silver_{_role}", O.with_roles(f"SELECT * FROM silver_{_role}", [_role]))(
        lambda spark, d, r=_role: _csv_silver(spark, d, r))


# ===================================== served from a refreshed lake (S6, S7, T*)
_LAKES: dict[tuple[str, str], str] = {}


def _lake(spark: SparkSession, d: str) -> Scorecards:
    """The whole tables as a refreshed lake, written on first use in a session and reopened afterwards."""
    from scorelake.plans.refresh import land_fixture, refresh
    key = (spark.sparkContext.applicationId, d)
    if key not in _LAKES:
        root = _scratch_lake(spark)
        refresh(spark, root, raw=land_fixture(spark, d, root))
        _LAKES[key] = root
    return Scorecards.from_lake(spark, _LAKES[key])


_RANK_KEYS = {"batsmen": ("total_runs", "total_matches"), "bowler": ("total_wickets", "total_matches"),
              "fielder": ("total_catches", "total_wicket_keeper_catches", "total_stumpings")}


def _ranking_sql(role: str, where: str = "", rows: str | None = None) -> str:
    """T1-T3 with positions."""
    keys = ", ".join(f"{k} DESC NULLS FIRST" for k in _RANK_KEYS[role])
    return (f"SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {keys}, full_name NULLS FIRST, country) AS position "
            f"FROM {rows or f'pt_{role}'}){where}")


for _role in ROLES:
    _fmt = {"batsmen": "T20", "bowler": "T20", "fielder": "Test"}[_role]
    s_ = spec(_role)
    # a page from the middle of each stored ranking
    _reg(f"ranking_page_{_role}", O.with_roles(_ranking_sql(_role, " WHERE position BETWEEN 401 AND 450"), [_role],
                                               extra=O.player_table_cte(_role)))(
        lambda spark, d, r=_role: _lake(spark, d).ranking_page(r, 401, 450))
    _keys = ", ".join(f"{O.num(O.q(k))} DESC" for k in s_.ranking_sort)
    _rest = ", ".join(f"{O.q(c)} ASC NULLS FIRST" for c in s_.ranking_columns)
    _reg(f"format_ranking_page_{_role}", _rows_sql(_role, (
        f"SELECT position, {', '.join(O.q(c) for c in s_.ranking_columns)} FROM (SELECT *, row_number() OVER "
        f"(ORDER BY {_keys}, {_rest}) AS position FROM rows_{_role} WHERE format = '{_fmt}') "
        f"WHERE position BETWEEN 26 AND 75")))(
        lambda spark, d, r=_role, f=_fmt: _lake(spark, d).format_ranking_page(r, f, 26, 75))
    _reg(f"ranked_page_{_role}", _rows_sql(_role, (
        f"SELECT position, full_name, value, country FROM (SELECT full_name, CAST(value AS BIGINT) AS value, country, "
        f"row_number() OVER (ORDER BY {O.num('value')} DESC, full_name) AS position FROM {_ranked_sql(_role, _fmt)}) "
        f"WHERE position BETWEEN 101 AND 200")))(
        lambda spark, d, r=_role, f=_fmt: _lake(spark, d).ranked_page(r, f, 101, 200))
    _reg(f"name_search_{_role}", _suggest_sql(_role, _fmt, "R#00000012", None))(
        lambda spark, d, r=_role, f=_fmt: board.suggestions(_lake(spark, d).board(r), r, f, "R#00000012"))
    # the board on stored cards gives what it gives on rows
    for _name in ("kpis", "profile", "versus", "versus_card", "versus_by_format", "format_bars", "metric_availability"):
        _fn = getattr(board, _name)
        _reg(f"stored_{_name}_{_role}", _SQL[f"{_name}_{_role}"])(
            (lambda spark, d, r=_role: board.metric_availability(_lake(spark, d).board(r), r))
            if _name == "metric_availability" else
            (lambda spark, d, fn=_fn, r=_role, f=_fmt: fn(_lake(spark, d).board(r), r, f)))

for _name, (_sql, _role, _fn) in _named.items():
    _reg(f"stored_{_name}", _sql)(lambda spark, d, fn=_fn, r=_role: fn(_lake(spark, d).board(r), r))


@_reg("refresh_one_name", O.with_roles(_ranking_sql("bowler"), ["bowler"], extra=O.player_table_cte("bowler")))
def _refresh_one_name(spark, d):
    """S6 by name: the player table is rebuilt with the ranking that hangs on it; the rest keeps its version."""
    from scorelake.plans import registry
    from scorelake.plans.refresh import refresh_derived
    from scorelake.sources.lake import Ledger
    _lake(spark, d)
    root = _LAKES[(spark.sparkContext.applicationId, d)]
    before = Ledger(spark, root)
    report = refresh_derived(spark, root, "player_stats_all_formats_bowler")
    after = Ledger(spark, root)
    for role in ROLES:
        for dataset in registry.parents(role):
            if (before.root_of(role, dataset) != after.root_of(role, dataset)) != (dataset in report.written):
                raise AssertionError(f"{dataset} changed with player_stats_all_formats_bowler, or did not follow it")
    cards = Scorecards.from_lake(spark, root)
    return cards.stored_ranking("bowler")


@_reg("reader_across_refreshes", O.with_roles(
    "SELECT 'before' AS reader, * FROM pt_fielder UNION ALL BY NAME SELECT 'after' AS reader, * FROM half",
    ["fielder"], extra=O.player_table_cte("fielder") + ",\n" + O.player_table_cte("fielder").replace(
        "pt_fielder AS", "half AS").replace("FROM silver_fielder", "FROM silver_fielder WHERE format <> 'Test'")))
def _reader_across_refreshes(spark, d):
    """A reader that was open keeps its tables through two refreshes; one opened later sees the new ones."""
    from scorelake.plans.refresh import land_fixture, refresh
    root = _scratch_lake(spark)
    raw = land_fixture(spark, d, root)["fielder"]
    refresh(spark, root, raw={"fielder": raw}, roles=("fielder",))
    reader = Scorecards.from_lake(spark, root)
    for _ in range(2):
        refresh(spark, root, raw={"fielder": raw.where(F.col("format") != "Test")}, roles=("fielder",))
    later = Scorecards.from_lake(spark, root)
    return reader.player_table("fielder").select(F.lit("before").alias("reader"), "*").union(
        later.player_table("fielder").select(F.lit("after").alias("reader"), "*"))


for _role in ROLES:
    _reg(f"type_report_{_role}", O.type_report(_role))(
        lambda spark, d, r=_role: drift.type_report(_sc(spark, d).raw(r), r))


def _named_tables_sql() -> str:
    """Rows of each of the 24 names."""
    derived = [(f"{r}_stats", f"silver_{r}") for r in ROLES] + [
        (f"player_stats_all_formats_{r}", f"pt_{r}") for r in ROLES]
    by_format = [(f"{f.lower()}_{r}_stats_country_wise", f"cw_{r}", f) for r in ROLES for f in FORMATS] + [
        (f"{r}_{f.lower()}", f"silver_{r}", f) for r in ROLES for f in FORMATS]
    parts = [f"SELECT '{n}' AS name, count(*) AS n FROM {t}" for n, t in derived]
    parts += [f"SELECT '{n}' AS name, count(*) AS n FROM {t} WHERE format = '{f}'" for n, t, f in by_format]
    return O.with_roles(" UNION ALL ".join(parts), list(ROLES), extra=",\n".join(
        f(r) for r in ROLES for f in (O.country_wise_cte, O.player_table_cte)))


@_reg("catalog_tables", _named_tables_sql())
def _catalog_tables(spark, d):
    """The 24 names written to the session's catalog, each read back by its name."""
    from functools import reduce
    from uuid import uuid4
    from scorelake.plans.refresh import write_tables
    database = f"scorelake_{uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_scratch_lake(spark)}/catalog'")
    names = write_tables(spark, _lake(spark, d).named_tables(), f"catalog:{database}")
    return reduce(DataFrame.union, [
        spark.table(f"{database}.{name}").agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")) for name in names])


def _sql_function(spark, d, query):
    from scorelake.plans import sqlfunctions
    sqlfunctions.register(_lake(spark, d))
    return spark.sql(query)


# P1-P6 as SQL table functions: the same rows as the functions of the library
for _role in ROLES:
    _fmt = _BOARD_FMT[_role]
    _cols = ", ".join(f"`{out}`" for _, out in spec(_role).serve[_fmt])
    _reg(f"sql_players_{_role}", _SQL[f"players_{_role}_{_fmt.lower()}"])(
        lambda spark, d, q=f"SELECT {_cols} FROM players('{_role}', '{_fmt}')": _sql_function(spark, d, q))
    _cols = ", ".join(COUNTRY_COLUMNS[_role])
    _reg(f"sql_country_all_{_role}", _SQL[f"country_all_{_role}"])(
        lambda spark, d, q=f"SELECT {_cols} FROM country_stats('{_role}', 'All')": _sql_function(spark, d, q))
    _reg(f"sql_country_list_{_role}", _SQL[f"country_list_{_role}_{_fmt.lower()}"])(
        lambda spark, d, q=f"SELECT {_cols} FROM country_stats('{_role}', '{_fmt}')": _sql_function(spark, d, q))
_reg("sql_country_filter", _SQL["country_filter"])(lambda spark, d: _sql_function(
    spark, d, f"SELECT {', '.join(COUNTRY_COLUMNS['bowler'])} FROM country_stats('bowler', 'ODI') "
    "WHERE country = 'Pakistan'"))
_reg("sql_ranking_top", O.with_roles(
    "SELECT full_name, country, total_wickets, position FROM (" + _ranking_sql("bowler") + ") WHERE position <= 25",
    ["bowler"], extra=O.player_table_cte("bowler")))(lambda spark, d: _sql_function(
        spark, d, "SELECT full_name, country, total_wickets, position FROM rankings('bowler') WHERE position <= 25"))


# ============================== text operators, if their subpackage is there
try:
    import corpus_pipeline
    from scorelake.llm import queries as _llm
except ModuleNotFoundError:
    pass
else:
    _SPARK.update(_llm.QUERIES, pipeline=corpus_pipeline.run)
    _SQL.update(_llm.SQL)
    if corpus_pipeline.ORACLE_SQL is not None:
        _SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

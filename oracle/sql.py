"""DuckDB SQL text for each registered query.

Every statement is self-contained: it derives the raw scorecards from the
driver's tables (the recipe of FIXTURES.md), cleans them and answers the
query.  DuckDB traps handled here: ``sum(int)`` is HUGEINT (cast BIGINT);
``TRY_CAST('3.5' AS INT)`` rounds (guarded by a pattern, Spark gives NULL);
``substring`` with a negative length counts backwards (guarded); rounding
goes through DECIMAL(38,10) as on the Spark side.
"""

from __future__ import annotations

from oracle.fixed import (
    BOARD_FORMAT_ORDER, BOARD_ROLE, COUNTRY_CODES, FIRST_METRICS, FORMATS, LOAD_FORMAT_ORDER,
    MAX_METRICS, MEAN_METRICS, spec,
)

_FIXTURE = r"""
base AS (
  SELECT o_custkey AS k, l_returnflag AS rf, count(DISTINCT l_orderkey) AS mat, count(*) AS inns,
         CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS runs, max(CAST(l_quantity AS INT)) AS hs,
         min(year(l_shipdate)) AS y0, max(year(l_shipdate)) AS y1,
         count(CASE WHEN l_linestatus = 'O' THEN 1 END) AS n_o, count(CASE WHEN l_discount > 0.05 THEN 1 END) AS n_w,
         count(CASE WHEN l_tax < 0.03 THEN 1 END) AS n_t, count(CASE WHEN l_quantity > 40 THEN 1 END) AS q40,
         count(CASE WHEN l_quantity > 25 THEN 1 END) AS q25, count(CASE WHEN l_quantity < 5 THEN 1 END) AS q5,
         count(CASE WHEN l_linenumber = 1 THEN 1 END) AS l1, count(CASE WHEN l_linenumber = 2 THEN 1 END) AS l2,
         count(CASE WHEN l_linenumber > 2 THEN 1 END) AS l3
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_returnflag),
h AS (
  SELECT *, CAST((runs*100 - (runs*100) % inns) / inns AS BIGINT) AS h_ave,
         CAST((runs*10000 - (runs*10000) % (runs+inns)) / (runs+inns) AS BIGINT) AS h_sr,
         CAST((inns*600 - (inns*600) % (mat+1)) / (mat+1) AS BIGINT) AS h_eco,
         CAST((runs*100 - (runs*100) % nullif(n_w,0)) / nullif(n_w,0) AS BIGINT) AS h_bave,
         CAST((runs*70 - (runs*70) % nullif(n_w,0)) / nullif(n_w,0) AS BIGINT) AS h_bsr
  FROM base),
once AS (
  SELECT concat(c_name, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE concat(' (',
           CASE WHEN c_custkey % 5 = 0 THEN 'ICC/' ELSE '' END,
           CASE c_nationkey % 6 WHEN 0 THEN 'INDIA' WHEN 1 THEN 'AUS' WHEN 2 THEN 'USA'
                WHEN 3 THEN 'SL' WHEN 4 THEN 'XYZ' ELSE 'PAK' END, ')') END) AS Player,
         CASE rf WHEN 'A' THEN 'ODI' WHEN 'N' THEN 'T20' ELSE 'Test' END AS format,
         concat(CAST(y0 AS STRING), '-', CAST(y1 AS STRING)) AS Span,
         CAST(mat AS STRING) AS Mat, CAST(inns AS STRING) AS Inns, CAST(runs AS STRING) AS Runs,
         CAST(n_o AS STRING) AS NO,
         CASE WHEN inns % 7 = 0 THEN '-' ELSE concat(CAST(hs AS STRING), CASE WHEN inns % 2 = 0 THEN '*' ELSE '' END) END AS HS,
         CASE WHEN inns % 5 = 0 THEN '-' ELSE concat(CAST(CAST(floor(h_ave / 100) AS BIGINT) AS STRING), '.', lpad(CAST(h_ave % 100 AS STRING), 2, '0')) END AS Ave,
         CASE WHEN inns % 9 = 0 THEN '-' ELSE CAST(runs + inns AS STRING) END AS BF,
         CASE WHEN inns % 9 = 0 THEN '-' ELSE concat(CAST(CAST(floor(h_sr / 100) AS BIGINT) AS STRING), '.', lpad(CAST(h_sr % 100 AS STRING), 2, '0')) END AS SR,
         CAST(q40 AS STRING) AS "100", CAST(q25 AS STRING) AS "50", CAST(q5 AS STRING) AS "0",
         CAST(l1 AS STRING) AS "4s", CAST(l2 AS STRING) AS "6s",
         CAST(runs AS STRING) AS Balls,
         CASE WHEN inns % 8 = 0 THEN CAST(CAST(floor(runs / 6) AS BIGINT) AS STRING)
              ELSE concat(CAST(CAST(floor(runs / 6) AS BIGINT) AS STRING), '.', CAST(runs % 6 AS STRING)) END AS Overs,
         CAST(n_t AS STRING) AS Mdns, CAST(n_w AS STRING) AS Wkts,
         concat(CAST(n_w AS STRING), '/', CAST(hs AS STRING)) AS BBI, concat(CAST(n_w + 1 AS STRING), '/', CAST(runs AS STRING)) AS BBM,
         CASE WHEN n_w = 0 THEN '-' ELSE concat(CAST(CAST(floor(h_bave / 100) AS BIGINT) AS STRING), '.', lpad(CAST(h_bave % 100 AS STRING), 2, '0')) END AS b_ave,
         CASE WHEN inns % 9 = 0 THEN '-' ELSE concat(CAST(CAST(floor(h_eco / 100) AS BIGINT) AS STRING), '.', lpad(CAST(h_eco % 100 AS STRING), 2, '0')) END AS Econ,
         CASE WHEN n_w = 0 THEN '-' ELSE concat(CAST(CAST(floor(h_bsr / 100) AS BIGINT) AS STRING), '.', lpad(CAST(h_bsr % 100 AS STRING), 2, '0')) END AS b_sr,
         CAST(q25 AS STRING) AS "4", CAST(q40 AS STRING) AS "5", CAST(q5 AS STRING) AS "10",
         CASE WHEN inns % 7 = 0 THEN '-' ELSE CAST(l1 + l2 AS STRING) END AS Dis, CAST(l1 AS STRING) AS Ct,
         CAST(l2 AS STRING) AS St, CAST(l3 AS STRING) AS "Ct Wk", CAST(l1 AS STRING) AS "Ct Fi", CAST(hs AS STRING) AS MD, '0.5' AS "D/I"
  FROM h JOIN customer ON k = c_custkey),
raw AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE length(Player) % 2 = 0 AND Runs LIKE '%3')"""

_ROLE_ALIASES = {"bowler": {"Ave": "b_ave", "SR": "b_sr"}}


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def role_raw_cte(role: str) -> str:
    s = spec(role)
    al = _ROLE_ALIASES.get(role, {})
    cols = []
    for c in s.raw_columns:
        src = q(al.get(c, c))
        having = [f for f in FORMATS if c in s.raw_by_format[f]]
        if len(having) < len(FORMATS):
            fl = ", ".join(f"'{f}'" for f in having)
            src = f"CASE WHEN format IN ({fl}) THEN {src} END"
        cols.append(f"{src} AS {q(c)}")
    return f"raw_{role} AS (SELECT {', '.join(cols)}, format FROM raw)"


def int_of(x: str) -> str:
    """Spark's try_cast(x AS INT): integer text only ('3.5' -> NULL)."""
    return (f"(CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') "
            f"THEN TRY_CAST(trim({x}) AS INTEGER) END)")


def float_of(x: str) -> str:
    return f"TRY_CAST({x} AS FLOAT)"


def country_case(code: str) -> str:
    whens = " ".join(f"WHEN contains({code}, '{k}') THEN '{v}'" for k, v in COUNTRY_CODES)
    return f"CASE {whens} END"


def _typed(role: str, name: str, typ: str) -> str:
    """One silver column, under its name."""
    return f"{typed_value(role, name, typ)} AS {q(name)}"


def typed_value(role: str, name: str, typ: str) -> str:
    s = spec(role)
    raw = next((r for r, t in s.renames.items() if t == name), name)
    if raw not in s.raw_columns:
        return f"CAST(NULL AS {_duck(typ)})"
    x = q(raw)
    if name == "years_active":
        e = f"({int_of(f'string_split({x}, chr(45))[2]')} - {int_of(f'string_split({x}, chr(45))[1]')})"
    elif name == "highest_score":
        e = int_of(f"(CASE WHEN contains({x}, '*') THEN substring({x}, 1, length({x}) - 1) ELSE {x} END)")
    elif name == "Overs":
        parts = f"string_split({x}, '.')"
        e = (f"(CASE WHEN contains({x}, '.') THEN {int_of(parts + '[1]')} * 6 + {int_of(parts + '[2]')}"
             f" WHEN {x} IS NOT NULL THEN 0 END)")
    elif typ == "string":
        e = x
    elif typ == "float":
        e = float_of(x)
    else:
        e = int_of(x)
    return e


def _duck(typ: str) -> str:
    return {"int": "INTEGER", "float": "FLOAT", "string": "VARCHAR", "bigint": "BIGINT",
            "double": "DOUBLE"}[typ]


def silver_cte(role: str, dedup: bool = True) -> str:
    s = spec(role)
    typed = [_typed(role, n, t) for n, t in s.silver if n not in ("full_name", "country", "format")]
    return (
        f"p_{role} AS (SELECT *, "
        f"array_to_string(list_filter(string_split(Player, ' '), lambda t: NOT contains(t, '(')), ' ') AS full_name, "
        f"list_filter(string_split(Player, ' '), lambda t: contains(t, '('))[-1] AS tok FROM raw_{role}),\n"
        f"c_{role} AS (SELECT *, CASE WHEN tok IS NULL OR length(tok) < 2 THEN '' "
        f"ELSE substring(tok, 2, length(tok) - 2) END AS code FROM p_{role}),\n"
        f"silver_{role} AS (SELECT {'DISTINCT ' if dedup else ''}full_name, {country_case('code')} AS country, "
        f"{', '.join(typed)}, format FROM c_{role} WHERE {country_case('code')} IS NOT NULL)"
    )


def with_roles(body: str, roles=(), silver=True, extra: str = "") -> str:
    ctes = [_FIXTURE.strip()]
    for r in roles:
        ctes.append(role_raw_cte(r))
        if silver:
            ctes.append(silver_cte(r))
    if extra:
        ctes.append(extra)
    return "WITH " + ",\n".join(ctes) + "\n" + body


def type_report(role: str) -> str:
    """Per format and raw column, the widest kind of text and the values that the cleaning loses."""
    s = spec(role)
    raw_of = {t: r for r, t in s.renames.items()}
    columns = [("Player", "full_name", "string")] + [
        (raw_of.get(n, n), n, t) for n, t in s.silver if n not in ("full_name", "country", "format")]
    parts = []
    for raw, name, typ in columns:
        x = q(raw) if raw in s.raw_columns else "CAST(NULL AS VARCHAR)"
        fits = country_case("code") if raw == "Player" else typed_value(role, name, typ)
        filled = f"coalesce(trim({x}) NOT IN ('', '-'), false)"
        lost = f"{filled} AND ({fits}) IS NULL"
        kind = (f"CASE WHEN NOT {filled} THEN 0 WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') THEN 1 "
                f"WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+[.][0-9]+') THEN 2 ELSE 3 END")
        parts.append(f"SELECT format, '{raw}' AS raw_column, '{name}' AS silver_column, '{typ}' AS contract, "
                     f"['empty', 'int', 'decimal', 'text'][max({kind}) + 1] AS kind, "
                     f"count(*) FILTER ({filled}) AS filled, count(*) FILTER ({lost}) AS unfit, "
                     f"min({x}) FILTER ({lost}) AS example FROM c_{role} GROUP BY format")
    return with_roles(" UNION ALL ".join(parts), [role])


# ---------------------------------------------------------------- helpers
def rnd(x: str, scale: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {scale}) AS DOUBLE)"


def bsum(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


def silver_cols(role: str) -> str:
    return ", ".join(q(n) for n in spec(role).silver_names)


def country_aggs(role: str) -> str:
    test = "format = 'Test'"
    if role == "batsmen":
        return ", ".join([
            "count(full_name) AS number_of_players",
            f"{bsum(q('Runs'))} AS total_runs",
            f"{rnd('avg(average)')} AS average_batting_average",
            f"CASE WHEN {test} THEN 0.0 ELSE {rnd('avg(strike_rate)')} END AS average_strike_rate",
            f"{bsum('hundreds')} AS total_hundreds", f"{bsum('fifties')} AS total_fifties",
            f"{bsum('ducks')} AS total_ducks",
            f"CASE WHEN {test} THEN CAST(NULL AS BIGINT) ELSE {bsum('balls_faced')} END AS total_balls_faced",
        ])
    if role == "bowler":
        return ", ".join([
            "count(full_name) AS number_of_players",
            f"{bsum('wickets')} AS total_wickets", f"{bsum(q('Runs'))} AS runs_conceded",
            f"{rnd('avg(average)')} AS average_bowling_average",
            f"{rnd('avg(strike_rate)', 0)} AS average_strike_rate",
            f"{rnd('avg(economy)')} AS average_economy",
            f"CASE WHEN {test} THEN CAST(0 AS BIGINT) ELSE {bsum('four_wicket_hauls')} END AS total_four_wicket_houls",
            f"{bsum('five_wicket_hauls')} AS total_five_wicket_hauls",
        ])
    return ", ".join([
        "count(full_name) AS number_of_players", f"{bsum('dismissals')} AS total_dismissals",
        f"{bsum('catches')} AS total_catches", f"{bsum('stumpings')} AS total_stumpings",
    ])


def country_wise_cte(role: str) -> str:
    return (f"cw_{role} AS (SELECT country, format, {country_aggs(role)} "
            f"FROM silver_{role} GROUP BY country, format)")


def pos_mean(c: str) -> str:
    return rnd(f"sum(CASE WHEN {c} > 0 THEN {c} ELSE 0 END) / "
               f"NULLIF(count(CASE WHEN {c} > 0 THEN 1 END), 0)")


def player_aggs(role: str) -> str:
    head = ["count(format) AS formats_played", "list_sort(array_agg(format)) AS format_list"]
    if role == "batsmen":
        rest = ["max(years_active) AS max_career_span", f"{bsum(q('Runs'))} AS total_runs",
                f"{bsum('matches_played')} AS total_matches", f"{bsum('not_outs')} AS total_not_outs",
                f"{bsum('hundreds')} AS total_centuries", f"{bsum('fifties')} AS total_fifties",
                f"{bsum('ducks')} AS total_ducks", f"{pos_mean('average')} AS total_average"]
    elif role == "bowler":
        rest = [f"{bsum('matches_played')} AS total_matches", f"{bsum('wickets')} AS total_wickets",
                f"{bsum(q('Runs'))} AS total_runs_conceded",
                f"{pos_mean('average')} AS average_bowling_average",
                f"{pos_mean('economy')} AS average_bowling_economy",
                f"{pos_mean('strike_rate')} AS average_bowling_strike_rate"]
    else:
        rest = [f"{bsum('catches')} AS total_catches",
                f"{bsum('catch_wickets')} AS total_wicket_keeper_catches",
                f"{bsum('stumpings')} AS total_stumpings"]
    return ", ".join(head + rest)


def player_table_cte(role: str) -> str:
    return (f"pt_{role} AS (SELECT full_name, country, {player_aggs(role)} "
            f"FROM silver_{role} GROUP BY full_name, country)")


def union_cols(role: str) -> str:
    return ", ".join(q(c) for c in spec(role).union_columns)


def serve_cols(role: str, fmt: str) -> str:
    return ", ".join(f"{q(src)} AS {q(out)}" for src, out in spec(role).serve[fmt])


def board_rows_cte(role: str) -> str:
    s = spec(role)
    out = {}
    for fmt in FORMATS:
        for src, name in s.serve[fmt]:
            if name == "balls" and name in out:
                out[name] = "CASE WHEN format = 'T20' THEN \"Overs\" ELSE \"Balls\" END"
            elif name not in out:
                out[name] = q(src)
    cols = ", ".join(f"{e} AS {q(n)}" for n, e in out.items())
    return f"rows_{role} AS (SELECT {cols}, '{BOARD_ROLE[role]}' AS role FROM silver_{role})"


def metric_agg(metric: str, cond: str | None = None) -> str:
    c = q(metric)
    if cond:
        c = f"CASE WHEN {cond} THEN {c} END"
    if metric in MEAN_METRICS:
        return f"avg({c})"
    if metric in MAX_METRICS:
        return f"max({c})"
    if metric in FIRST_METRICS:
        order = ", ".join(f"'{f}'" for f in LOAD_FORMAT_ORDER)
        return (f"min(CASE WHEN {c} IS NOT NULL THEN {{'o': list_position([{order}], format), "
                f"'v': {c}}} END).v")
    return f"sum({c})"


def num(x: str) -> str:
    return f"coalesce(CAST({x} AS DOUBLE), 0.0)"


__all__ = ["with_roles", "silver_cte", "role_raw_cte", "country_wise_cte", "player_table_cte",
           "board_rows_cte", "metric_agg", "num", "rnd", "bsum", "q", "union_cols", "serve_cols",
           "silver_cols", "BOARD_FORMAT_ORDER"]

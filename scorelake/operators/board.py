"""Board computations (B1-B12, T5-T14) as Spark plans.

The source dashboard ships every player row to the browser and groups,
sorts and slices there.  Here each board element is one plan over the
role's rows and only the handful of result rows leave the cluster.

Rows are the serving projections of a role's formats (``board_rows``): one
projection of the silver role dataset, no union, no shuffle.

Players are picked in-plan: the default player is rank 1 of the role's
primary metric in the chosen format, the rival the best other one (T12).
A pick is a one-row frame (``limit``), joined back with a broadcast
semi-join; nothing is collected to the driver.  Each function also takes a
``Board``, the stored cards of a refreshed lake: one row per player and
format with its metrics and rank position, so a pick is a filter on the
position and a player's values are one stored row.  Where the result is a list
of metrics (KPIs, profile, comparisons), values are computed as
conditional aggregates in one pass and turned into rows with ``stack``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.specs import (
    ASCENDING_BOWLING_METRICS,
    BOARD_FORMAT_ORDER,
    BOARD_ROLE,
    FIRST_METRICS,
    FORMATS,
    LOAD_FORMAT_ORDER,
    MAX_METRICS,
    MEAN_METRICS,
    check_format,
    spec,
)


# --------------------------------------------------------------- rows
def board_rows(silver: DataFrame, role: str) -> DataFrame:
    """A role's serving rows of all formats, tagged with the role.

    Equal to the union of the three per-format player lists with missing
    fields NULL; written as one projection since the silver role dataset
    already holds every format with absent columns NULL.
    """
    s = spec(role)
    out: dict[str, Column] = {}
    for fmt in FORMATS:
        for src, name in s.serve[fmt]:
            c = F.col(f"`{src}`")
            if name in out and name == "balls":
                # bowling "balls" is Balls in ODI/Test and Overs (in balls) in T20
                out[name] = F.when(F.col("format") == "T20", F.col("Overs")).otherwise(
                    F.col("Balls"))
            elif name not in out:
                out[name] = c
    cols = [c.alias(n) for n, c in out.items()]
    return silver.select(*cols, F.lit(BOARD_ROLE[role]).alias("role"))


@dataclass(frozen=True)
class Board:
    """What a refresh stores for a role's board.

    ``cards``: a row per format and player: the metrics collapsed as B1 says, value (the primary one), country,
    countries, position (T9), players (of the format) and block. ``available``: one row of flags
    ``has_<metric>`` (B2). ``index``: postings of the trigrams of names (T10), if there are any.
    """

    cards: DataFrame
    available: DataFrame
    index: DataFrame | None = None


def card_metrics(role: str) -> tuple[str, ...]:
    """Every metric that the role's board shows."""
    s = spec(role)
    return tuple(dict.fromkeys((*s.metrics, *s.kpis, *s.profile)))


def cards(rows: DataFrame, role: str) -> DataFrame:
    """Per format and player: the board metrics, value, country and countries (positions come with storing).

    Collapsing a card again leaves it as it is, so cards stand in for rows in every board function."""
    return rows.groupBy("format", "full_name").agg(
        *[metric_agg(m).alias(m) for m in card_metrics(role)], metric_agg(spec(role).primary).alias("value"),
        F.min("country").alias("country"),
        F.array_sort(F.collect_set(F.when(F.col("country") != "", F.col("country")))).alias("countries"))


def card_order() -> list[Column]:
    """By value, NULL as 0; ties by name."""
    return [_num(F.col("value")).desc(), F.col("full_name")]


def availability_flags(rows: DataFrame, role: str) -> DataFrame:
    """B2 as one row: ``has_<metric>`` over the rows of every format."""
    return rows.agg(*[F.coalesce(F.max(F.col(m).isNotNull()), F.lit(False)).alias(f"has_{m}")
                      for m in card_metrics(role)])


def _frame(rows: DataFrame | Board) -> DataFrame:
    return rows.cards if isinstance(rows, Board) else rows


def _at(*positions: int) -> Column:
    """The cards at these (first) positions: all in the first block."""
    return (F.col("block") == 0) & F.col("position").isin(*positions)


def relevant(rows: DataFrame | Board, fmt: str | None) -> DataFrame:
    """Rows of one format (None: all formats)."""
    rows = _frame(rows)
    if fmt is None:
        return rows
    return rows.where(F.col("format") == check_format(fmt, allow_all=False))


# ------------------------------------------------------------- B1 metric kinds
def _format_rank(order: tuple[str, ...]) -> Column:
    return F.array_position(F.array(*[F.lit(f) for f in order]), F.col("format"))


def metric_agg(metric: str, cond: Column | None = None) -> Column:
    """B1: one player's rows -> one value, by metric kind; NULLs skipped.

    mean for rates, max for highest score, first (in load order ODI, T20,
    Test; smallest value within a format) for best innings/match, sum
    otherwise.  No value -> NULL.  ``cond`` restricts the rows (conditional
    aggregate), so many metrics and players share one pass.
    """
    c = F.col(metric)
    if cond is not None:
        c = F.when(cond, c)
    if metric in MEAN_METRICS:
        return F.avg(c)
    if metric in MAX_METRICS:
        return F.max(c)
    if metric in FIRST_METRICS:
        c = F.nullif(c, F.lit(""))  # an empty text is no value
        first = F.min(F.when(c.isNotNull(), F.struct(_format_rank(LOAD_FORMAT_ORDER).alias("o"),
                                                     c.alias("v"))))
        return first.getField("v")
    return F.sum(c)


def _num(c: Column) -> Column:
    """JS ``Number(v) || 0``: NULL (and 0) count as 0 in comparisons."""
    return F.coalesce(c.cast("double"), F.lit(0.0))


# -------------------------------------------------------- ranking and picking
def ranked_players(rows: DataFrame, role: str, fmt: str) -> DataFrame:
    """Players of (role, format) with their primary metric, best first.

    Grouped by name only, like the board (namesakes merge; the country is
    the smallest of theirs).  Ties break by name.
    """
    if isinstance(rows, Board):
        return relevant(rows, fmt).select("full_name", "value", "country", "position").orderBy("position").drop("position")
    return _per_player(rows, fmt, spec(role).primary).orderBy(*card_order())


def _per_player(rows: DataFrame | Board, fmt: str, metric: str) -> DataFrame:
    """(full_name, value, country) of a format's players; a card already is that."""
    if isinstance(rows, Board):
        return relevant(rows, fmt).select("full_name", F.col(metric).alias("value"), "country")
    return relevant(rows, fmt).groupBy("full_name").agg(
        metric_agg(metric).alias("value"), F.min("country").alias("country"))


def pick_player(rows: DataFrame | Board, role: str, fmt: str, player: str | None = None,
                exclude: DataFrame | str | None = None) -> DataFrame:
    """A one-row frame ``(full_name)``: the given name, or the best one.

    ``exclude`` (a name or a one-row pick) is skipped, which gives the
    rival; if nobody else is there, the rival is the excluded player.
    """
    if isinstance(rows, Board):
        first = 2 if exclude is not None else 1  # the rival is the best of the first two that is not excluded
        ranked = relevant(rows, fmt).where(_at(*range(1, first + 1))).select("full_name", "value")
    else:
        ranked = ranked_players(rows, role, fmt).select("full_name", "value")
    if player is not None:
        return ranked.sparkSession.range(1).select(F.lit(player).alias("full_name"))
    if exclude is None:
        return ranked.limit(1).select("full_name")
    if isinstance(exclude, str):
        others = ranked.where(F.col("full_name") != exclude)
        fallback = ranked.sparkSession.range(1).select(F.lit(exclude).alias("full_name"))
    else:
        ex = exclude.select(F.col("full_name").alias("__ex"))
        others = ranked.join(F.broadcast(ex), F.col("full_name") == F.col("__ex"),
                             "left_anti")
        fallback = exclude.select("full_name")
    # the best other, else the excluded one: order the two candidates
    best_other = others.orderBy(_num(F.col("value")).desc(), F.col("full_name")).limit(1)
    cands = (best_other.select("full_name", F.lit(0).alias("__p"))
             .unionByName(fallback.select("full_name", F.lit(1).alias("__p"))))
    return cands.orderBy("__p").limit(1).select("full_name")


def _is(player: str) -> Column:
    return F.coalesce(F.col("full_name") == F.lit(player), F.lit(False))


def _chosen(rows: DataFrame | Board, role: str, fmt: str, player: str | None,
            here: bool = False) -> DataFrame | Column | str:
    """A named player as the name itself, else the best one: as a one-row frame, or, where only
    the format's cards are looked at (``here``), as a condition on them."""
    if player is not None:
        return player
    if here and isinstance(rows, Board):
        return (F.col("format") == fmt) & _at(1)
    return pick_player(rows, role, fmt)


def _only(rows: DataFrame, pick: DataFrame | Column | str) -> DataFrame:
    """Rows of one player: a literal filter for a name or position, a broadcast
    semi-join for a one-row pick."""
    if isinstance(pick, Column):
        return rows.where(pick)
    if isinstance(pick, str):
        return rows.where(F.col("full_name") == F.lit(pick))
    return rows.join(F.broadcast(pick), "full_name", "left_semi")


def _flag(rows: DataFrame, pick: DataFrame | Column | str, name: str) -> DataFrame:
    if isinstance(pick, (Column, str)):
        return rows.withColumn(name, _is(pick) if isinstance(pick, str) else F.coalesce(pick, F.lit(False)))
    p = pick.select(F.col("full_name").alias(f"__{name}"), F.lit(True).alias(name))
    return (rows.join(F.broadcast(p), F.col("full_name") == F.col(f"__{name}"), "left")
            .drop(f"__{name}").fillna(False, subset=[name]))


# -------------------------------------------------------- B2 availability etc.
def _long(df_one_row: DataFrame, items: list[tuple[str, dict[str, str]]],
          out: list[tuple[str, str]], carry: tuple[str, ...] = ()) -> DataFrame:
    """Turn one wide row into one row per item with ``stack``.

    ``items`` is [(label, {out_col: wide_col})]; ``out`` is [(out_col, type)];
    ``carry`` columns of the wide row are repeated on every output row.
    """
    parts = []
    for label, m in items:
        parts.append(f"'{label}'")
        for oc, typ in out:
            parts.append(f"CAST(`{m[oc]}` AS {typ})" if oc in m else f"CAST(NULL AS {typ})")
    names = ", ".join(["metric"] + [oc for oc, _ in out])
    return df_one_row.selectExpr(f"stack({len(items)}, {', '.join(parts)}) AS ({names})",
                                 *[f"`{c}`" for c in carry])


def metric_availability(rows: DataFrame, role: str) -> DataFrame:
    """B2: per board metric of the role, whether any row (any format) has it."""
    s = spec(role)
    if isinstance(rows, Board):
        one = rows.available.select(*[F.col(f"has_{m}").alias(f"a{i}") for i, m in enumerate(s.metrics)])
    else:
        one = rows.agg(*[F.max(F.col(m).isNotNull()).alias(f"a{i}") for i, m in enumerate(s.metrics)])
    out = _long(one, [(m, {"available": f"a{i}"}) for i, m in enumerate(s.metrics)],
                [("available", "BOOLEAN")])
    pos = F.array_position(F.array(*[F.lit(m) for m in s.metrics]), F.col("metric")).cast("int")
    return out.select("metric", pos.alias("position"),
                      F.coalesce("available", F.lit(False)).alias("available"))


def _metric_values(rows: DataFrame, role: str, metrics: tuple[str, ...], fmt: str,
                   picks, limit: int | None, carry: dict[str, Column] | None = None,
                   pair: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Long frame (metric, position, <pick> values...) for available metrics.

    Availability is over the role's rows of every format (B2); values are
    over the picked players' rows of ``fmt``.  One aggregation pass;
    ``carry`` aggregates (e.g. a country) are repeated on every row.
    Of a ``Board`` only the picked cards and the row of flags are read.
    """
    text = any(m in FIRST_METRICS for m in metrics)
    stored = isinstance(rows, Board)
    flagged = relevant(rows, fmt) if stored else rows
    if stored:
        for pick in picks.values() if pair is None else ():
            flagged = _only(flagged, F.col("full_name") == pick if isinstance(pick, str) else pick)
    if pair is not None:  # a compared pair: flags "first"/"second"
        flagged = pair(flagged)
        if stored:
            flagged = flagged.where(F.col("first") | F.col("second"))
    else:
        for name, pick in picks.items():
            flagged = _flag(flagged, pick, name)
    if stored:
        flagged = flagged.unionByName(rows.available, allowMissingColumns=True)
    in_fmt = F.col("format") == fmt
    aggs = []
    for i, m in enumerate(metrics):
        aggs.append(F.max(F.col(f"has_{m}") if stored else F.col(m).isNotNull()).alias(f"a{i}"))
        for name in picks:
            v = metric_agg(m, in_fmt & F.col(name))
            if m in FIRST_METRICS:
                pass
            elif text and m not in MEAN_METRICS:
                v = v.cast("bigint").cast("string")  # integer sums print exactly
            else:
                v = v.cast("string" if text else "double")
            aggs.append(v.alias(f"{name}{i}"))
    carry = carry or {}
    aggs += [c.alias(k) for k, c in carry.items()]
    one = flagged.agg(*aggs)
    # position among the available metrics, computed on the single row
    running = F.lit(0)
    ranks = []
    for i in range(len(metrics)):
        running = running + F.coalesce(F.col(f"a{i}"), F.lit(False)).cast("int")
        ranks.append(running.alias(f"r{i}"))
    one = one.select("*", *ranks)
    out_cols = [("position", "INT"), ("available", "BOOLEAN")]
    for name in picks:
        out_cols.append((name, "STRING" if text else "DOUBLE"))
    items = []
    for i, m in enumerate(metrics):
        mapping = {"position": f"r{i}", "available": f"a{i}"}
        mapping.update({name: f"{name}{i}" for name in picks})
        items.append((m, mapping))
    long = _long(one, items, out_cols, tuple(carry)).where(F.col("available"))
    if limit is not None:
        long = long.where(F.col("position") <= limit)
    return long.drop("available")


def _slots(rows: DataFrame, role: str, fmt: str, player: str | None = None,
           rival: str | None = None) -> DataFrame:
    """The compared pair as at most two rows ``(full_name, first, second)``.

    By default the player is rank 1 and the rival the best other one (rank
    2), or the player again when nobody else is there.  Both come from one
    top-2 of the ranking; the window numbers those two rows only.
    """
    from pyspark.sql.window import Window
    if isinstance(rows, Board):  # the best two are two stored rows
        ranked = relevant(rows, fmt).where(_at(1, 2)).select("full_name", "value")
    else:
        ranked = ranked_players(rows, role, fmt).select("full_name", "value")
    order = [_num(F.col("value")).desc(), F.col("full_name")]
    spark = ranked.sparkSession
    if player is None and rival is None:
        top2 = ranked.orderBy(*order).limit(2)
        w = Window.orderBy(*order)
        numbered = top2.select("full_name", F.row_number().over(w).alias("r"),
                               F.count(F.lit(1)).over(Window.partitionBy()).alias("n"))
        return numbered.select("full_name", (F.col("r") == 1).alias("first"),
                               ((F.col("r") == 2) | (F.col("n") == 1)).alias("second"))
    if player is None:
        a = ranked.orderBy(*order).limit(1).select("full_name")
    else:
        a = spark.range(1).select(F.lit(player).alias("full_name"))
    if rival is None:
        # best other than the (named) player, else the player
        others = ranked.where(~_is(player))
        cands = (others.orderBy(*order).limit(1).select("full_name", F.lit(0).alias("__p"))
                 .unionByName(a.select("full_name", F.lit(1).alias("__p"))))
        b = cands.orderBy("__p").limit(1).select("full_name")
    else:
        b = spark.range(1).select(F.lit(rival).alias("full_name"))
    both = (a.select("full_name", F.lit(True).alias("first"), F.lit(False).alias("second"))
            .unionByName(b.select("full_name", F.lit(False).alias("first"),
                                  F.lit(True).alias("second"))))
    return both.groupBy("full_name").agg(F.max("first").alias("first"),
                                         F.max("second").alias("second"))


def _pair(rows: DataFrame, role: str, fmt: str, player: str | None,
          rival: str | None, here: bool = False) -> Callable[[DataFrame], DataFrame]:
    """Adds boolean ``first``/``second`` columns to a frame: literals if both
    players are named, else one broadcast join with the (at most two-row)
    slots frame; positions, if only the format's cards are flagged (``here``)
    and no default rival of a named player has to be found."""
    if here and isinstance(rows, Board) and (player is None or rival is not None):
        first = _at(1) if player is None else _is(player)
        second = _is(rival) if rival is not None else _at(2) | (_at(1) & (F.col("players") == 1))
        return lambda df: df.withColumns({"first": first, "second": second})
    if player is not None and rival is not None:
        return lambda df: df.withColumns({"first": _is(player), "second": _is(rival)})
    slots = _slots(rows, role, fmt, player, rival)
    return lambda df: _flag_pair(df, slots)


def _flag_pair(rows: DataFrame, slots: DataFrame) -> DataFrame:
    sl = slots.select(F.col("full_name").alias("__n"), "first", "second")
    return (rows.join(F.broadcast(sl), F.col("full_name") == F.col("__n"), "left")
            .drop("__n").fillna(False, subset=["first", "second"]))


def kpis(rows: DataFrame, role: str, fmt: str, player: str | None = None) -> DataFrame:
    """The role's KPI metrics (the available ones) of a player."""
    a = _chosen(rows, role, fmt, player, here=True)
    return _metric_values(rows, role, spec(role).kpis, fmt, {"value": a}, None)


def profile(rows: DataFrame, role: str, fmt: str, player: str | None = None) -> DataFrame:
    """The role's profile metrics (the available ones) of a player."""
    a = _chosen(rows, role, fmt, player, here=True)
    return _metric_values(rows, role, spec(role).profile, fmt, {"value": a}, None)


def versus_card(rows: DataFrame, role: str, fmt: str, player: str | None = None) -> DataFrame:
    """First four available board metrics of a player, with the country."""
    a = _chosen(rows, role, fmt, player, here=True)
    mine = (F.col("format") == fmt) & F.col("value")
    country = F.coalesce(F.min(F.when(mine, F.col("country"))), F.lit("Unknown country"))
    return _metric_values(rows, role, spec(role).metrics, fmt, {"value": a}, 4,
                          carry={"country": country})


def versus(rows: DataFrame, role: str, fmt: str, player: str | None = None,
           rival: str | None = None) -> DataFrame:
    """Player vs rival over the first five available metrics.

    Per metric: both values, each as % of the larger (at least 1, bars
    floored at 5) and whether the first wins (a tie goes to the second).
    """
    pair = _pair(rows, role, fmt, player, rival, here=True)
    vals = _metric_values(rows, role, spec(role).metrics, fmt, ("first", "second"), 5,
                          pair=pair)
    return _percentages(vals, floor=5.0)


def _percentages(vals: DataFrame, floor: float) -> DataFrame:
    f, s = _num(F.col("first")), _num(F.col("second"))
    top = F.greatest(f, s, F.lit(1.0))
    return vals.select(
        "*",
        F.greatest(f / top * 100, F.lit(floor)).alias("first_pct"),
        F.greatest(s / top * 100, F.lit(floor)).alias("second_pct"),
        (f > s).alias("first_wins"),
    )


def versus_by_format(rows: DataFrame, role: str, fmt: str, player: str | None = None,
                     rival: str | None = None) -> DataFrame:
    """Player vs rival on the primary metric in each format (all shown)."""
    primary = spec(role).primary
    flagged = _pair(rows, role, fmt, player, rival)(_frame(rows))
    aggs = []
    for i, f in enumerate(BOARD_FORMAT_ORDER):
        in_f = F.col("format") == f
        aggs.append(metric_agg(primary, in_f & F.col("first")).cast("double").alias(f"first{i}"))
        aggs.append(metric_agg(primary, in_f & F.col("second")).cast("double").alias(f"second{i}"))
    one = flagged.agg(*aggs)
    top = F.greatest(F.lit(1.0), *[_num(F.col(f"{w}{i}")) for w in ("first", "second")
                                   for i in range(len(BOARD_FORMAT_ORDER))])
    one = one.select("*", top.alias("top"))
    long = _long(one, [(f, {"first": f"first{i}", "second": f"second{i}", "top": "top"})
                       for i, f in enumerate(BOARD_FORMAT_ORDER)],
                 [("first", "DOUBLE"), ("second", "DOUBLE"), ("top", "DOUBLE")])
    long = long.withColumnRenamed("metric", "format")
    fv, sv = _num(F.col("first")), _num(F.col("second"))
    return long.select(
        "format",
        (F.array_position(F.array(*[F.lit(x) for x in BOARD_FORMAT_ORDER]),
                          F.col("format"))).cast("int").alias("position"),
        "first", "second",
        F.greatest(fv / F.col("top") * 100, F.lit(5.0)).alias("first_pct"),
        F.greatest(sv / F.col("top") * 100, F.lit(5.0)).alias("second_pct"),
        (fv > sv).alias("first_wins"),
    )


def format_bars(rows: DataFrame, role: str, fmt: str, player: str | None = None) -> DataFrame:
    """A player's primary metric per format (Test, ODI, T20), % of max.

    Every format is shown, also without rows; bars floor at 2 %.
    """
    primary = spec(role).primary
    a = _chosen(rows, role, fmt, player)
    mine = _only(_frame(rows), a)
    aggs = [metric_agg(primary, F.col("format") == f).cast("double").alias(f"v{i}")
            for i, f in enumerate(BOARD_FORMAT_ORDER)]
    one = mine.agg(*aggs)
    top = F.greatest(F.lit(1.0), *[_num(F.col(f"v{i}")) for i in range(len(BOARD_FORMAT_ORDER))])
    one = one.select("*", top.alias("top"))
    long = _long(one, [(f, {"value": f"v{i}", "top": "top"})
                       for i, f in enumerate(BOARD_FORMAT_ORDER)],
                 [("value", "DOUBLE"), ("top", "DOUBLE")]).withColumnRenamed("metric", "format")
    return long.select(
        "format",
        F.array_position(F.array(*[F.lit(x) for x in BOARD_FORMAT_ORDER]),
                         F.col("format")).cast("int").alias("position"),
        "value",
        F.greatest(_num(F.col("value")) / F.col("top") * 100, F.lit(2.0)).alias("pct"),
    )


def best_format(rows: DataFrame, role: str, fmt: str, player: str | None = None,
                scope: str = "format") -> DataFrame:
    """The format with the largest primary value (ties: Test, ODI, T20).

    ``scope="format"`` looks at the current format's rows only, as the
    board's profile card does; ``"all"`` at every format.
    """
    primary = spec(role).primary
    a = _chosen(rows, role, fmt, player, here=scope == "format")
    mine = _only(relevant(rows, fmt if scope == "format" else None), a)
    structs = []
    for i, f in enumerate(BOARD_FORMAT_ORDER):
        v = metric_agg(primary, F.col("format") == f).cast("double")
        structs.append(F.struct(_num(v).alias("v"), F.lit(-i).alias("o"), F.lit(f).alias("f"),
                                v.alias("value")))
    best = F.greatest(*structs)
    return mine.agg(best.alias("b")).select(F.col("b.f").alias("best_format"),
                                            F.col("b.value").alias("value"))


# ------------------------------------------------------------------ lists/top-k
def leaderboard(rows: DataFrame, role: str, fmt: str, metric: str | None = None,
                top: int = 12) -> DataFrame:
    """Top players of (role, format) by a board metric, ranked 1..12.

    Players with no value are left out.  Bowling average, economy and strike
    rate rank ascending with 0 and NULL last; every other metric descending
    with NULL as 0.  The rank is a row number over the (at most 12) rows
    that the top-k step keeps.
    """
    s = spec(role)
    metric = metric or s.primary
    per = _per_player(rows, fmt, metric).where(F.col("value").isNotNull())
    if role == "bowler" and metric in ASCENDING_BOWLING_METRICS:
        v = F.col("value").cast("double")
        order = [F.when(v != 0, v).asc_nulls_last(), F.col("full_name")]
    else:
        order = [_num(F.col("value")).desc(), F.col("full_name")]
    best = per.orderBy(*order).limit(top)
    from pyspark.sql.window import Window
    w = Window.orderBy(*order)  # over the <= top rows kept above
    return best.select(F.row_number().over(w).alias("rank"), "full_name", "country",
                       F.col("value").cast("double").alias("value"))


# ------------------------------------------------ name search (T10) by trigrams
#: Characters of a gram of the name index; shorter queries scan the cards.
GRAM = 3


def postings(numbered_cards: DataFrame) -> DataFrame:
    """The name index: a row per distinct trigram of each lower-cased name and its card."""
    low = F.lower(F.col("full_name"))
    # a name shorter than a gram has none, and no query of a gram or more is in it
    starts = F.when(F.length(low) >= GRAM, F.sequence(F.lit(1), F.length(low) - GRAM + 1)).otherwise(
        F.array().cast("array<int>"))
    grams = F.array_distinct(F.transform(starts, lambda i: F.substr(low, i, F.lit(GRAM))))
    return numbered_cards.select(F.explode(grams).alias("gram"), "format", "position", "full_name", "value", "country")


def relevant_postings(index: DataFrame, fmt: str) -> DataFrame:
    return index.where(F.col("format") == check_format(fmt, allow_all=False))


def search(index: DataFrame, query: str) -> DataFrame:
    """(full_name, value, country) of the names that hold ``query`` (lower case, GRAM characters or more):
    the postings of its trigrams, intersected by position, then verified on the name."""
    grams = sorted({query[i:i + GRAM] for i in range(len(query) - GRAM + 1)})
    hits = index.where(F.col("gram").isin(*grams))
    if len(grams) > 1:
        hits = hits.groupBy("position", "full_name").agg(
            F.count(F.lit(1)).alias("n"), F.first("value").alias("value"), F.first("country").alias("country")
        ).where(F.col("n") == len(grams))
    return hits.where(F.lower(F.col("full_name")).contains(query)).select("full_name", "value", "country")


def suggestions(rows: DataFrame, role: str, fmt: str, query: str = "",
                exclude: str | None = None, exclude_selected: bool = False,
                top: int = 8) -> DataFrame:
    """Up to 8 names containing ``query`` (any case), best first.

    ``exclude_selected`` drops the currently selected player (the default
    pick unless ``exclude`` names one), as the compare box does.
    """
    query = query.strip().lower()
    if isinstance(rows, Board) and rows.index is not None and len(query) >= GRAM:
        ranked = search(relevant_postings(rows.index, fmt), query)
    else:
        ranked = _per_player(rows, fmt, spec(role).primary)
        if query:
            ranked = ranked.where(F.lower(F.col("full_name")).contains(query))
    if exclude_selected or exclude is not None:
        sel = _chosen(rows, role, fmt, exclude)
        if isinstance(sel, str):
            ranked = ranked.where(~_is(sel))
        else:
            ranked = ranked.join(F.broadcast(sel.select(F.col("full_name").alias("__sel"))),
                                 F.col("full_name") == F.col("__sel"), "left_anti")
    order = [_num(F.col("value")).desc(), F.col("full_name")]
    best = ranked.orderBy(*order).limit(top)
    from pyspark.sql.window import Window
    return best.select(F.row_number().over(Window.orderBy(*order)).alias("rank"),
                       "full_name", "country", F.col("value").cast("double").alias("value"))


def default_and_rival(rows: DataFrame, role: str, fmt: str) -> DataFrame:
    """The default player and the default comparison player."""
    slots = _slots(rows, role, fmt)
    pairs = F.array(F.when(F.col("first"), F.struct(F.lit("player").alias("slot"),
                                                    F.col("full_name").alias("full_name"))),
                    F.when(F.col("second"), F.struct(F.lit("rival").alias("slot"),
                                                     F.col("full_name").alias("full_name"))))
    return (slots.select(F.explode(pairs).alias("p")).where(F.col("p").isNotNull())
            .select("p.slot", "p.full_name"))


def player_names(rows: DataFrame, fmt: str) -> DataFrame:
    """Distinct names of (role, format) in locale order (Unicode collation:
    accents and case count only between otherwise equal names)."""
    return (relevant(rows, fmt).where(F.col("full_name").isNotNull()
                                      & (F.col("full_name") != ""))
            .select("full_name").distinct()
            .orderBy(F.collate("full_name", "UNICODE"), "full_name"))


def player_count(*role_rows: DataFrame | Board) -> DataFrame:
    """Distinct player names over every role and format loaded."""
    names = [_frame(r).select("full_name") for r in role_rows]
    u = names[0]
    for n in names[1:]:
        u = u.unionByName(n)
    return u.agg(F.count_distinct("full_name").alias("player_count"))


def player_header(rows: DataFrame, role: str, fmt: str, player: str | None = None,
                  scope: str = "format") -> DataFrame:
    """A player's name, countries and formats (Test, ODI, T20 order)."""
    a = _chosen(rows, role, fmt, player, here=scope == "format")
    mine = _only(relevant(rows, fmt if scope == "format" else None), a)
    if isinstance(rows, Board):
        countries = F.array_sort(F.array_distinct(F.flatten(F.collect_list("countries"))))
    else:
        countries = F.array_sort(F.collect_set(F.when(F.col("country") != "", F.col("country"))))
    have = [F.max(F.col("format") == f).alias(f"h{i}") for i, f in enumerate(BOARD_FORMAT_ORDER)]
    one = mine.agg(
        F.min("full_name").alias("full_name"), countries.alias("countries"), *have)
    formats = F.filter(F.array(*[F.when(F.col(f"h{i}"), F.lit(f))
                                 for i, f in enumerate(BOARD_FORMAT_ORDER)]),
                       lambda x: x.isNotNull())
    return one.select("full_name", "countries", formats.alias("formats"))


def compare_header(rows: DataFrame, role: str, fmt: str, player: str | None = None,
                   rival: str | None = None) -> DataFrame:
    """The country of each compared player ("Unknown" if none)."""
    flagged = _pair(rows, role, fmt, player, rival, here=True)(relevant(rows, fmt))
    if isinstance(rows, Board):
        flagged = flagged.where(F.col("first") | F.col("second"))
    one = flagged.agg(*[
        F.min(F.when(F.col(w), F.col(c))).alias(f"{w}_{c}")
        for w in ("first", "second") for c in ("full_name", "country")])
    long = _long(one, [("player", {"full_name": "first_full_name", "country": "first_country"}),
                       ("rival", {"full_name": "second_full_name", "country": "second_country"})],
                 [("full_name", "STRING"), ("country", "STRING")])
    return long.select(F.col("metric").alias("slot"), "full_name",
                       F.coalesce("country", F.lit("Unknown")).alias("country"))


def format_ranking(rows: DataFrame, role: str, fmt: str, top: int = 25) -> DataFrame:
    """A format's player rows by the role's sort keys, first 25.

    Keys descend with NULL as 0; ties break by name, country and the other
    shown columns so the cut at 25 is deterministic.
    """
    return (relevant(rows, fmt).orderBy(*format_ranking_order(role)).limit(top)
            .select(*spec(role).ranking_columns))


def format_ranking_order(role: str) -> list[Column]:
    s = spec(role)
    return [*[_num(F.col(k)).desc() for k in s.ranking_sort], *[F.col(c).asc_nulls_first() for c in s.ranking_columns]]


def format_ranking_rows(rows: DataFrame, role: str) -> DataFrame:
    """The shown columns and the sort keys of T5, for every format."""
    s = spec(role)
    return rows.select("format", *dict.fromkeys((*s.ranking_columns, *s.ranking_sort)))


# Columns the board shows for the all-format rankings and country tables
RANKING_VIEW_COLUMNS = {
    "batsmen": ("full_name", "country", "formats_played", "total_matches", "total_runs",
                "total_centuries", "total_fifties", "total_average"),
    "bowler": ("full_name", "country", "formats_played", "total_matches", "total_wickets",
               "average_bowling_average", "average_bowling_economy"),
    "fielder": ("full_name", "country", "formats_played", "total_catches",
                "total_wicket_keeper_catches", "total_stumpings"),
}
COUNTRY_VIEW_COLUMNS = {
    "batsmen": ("country", "number_of_players", "total_runs", "average_batting_average",
                "average_strike_rate", "total_hundreds", "total_fifties", "total_ducks"),
    "bowler": ("country", "number_of_players", "total_wickets", "runs_conceded",
               "average_bowling_average", "average_economy", "total_five_wicket_hauls"),
    "fielder": ("country", "number_of_players", "total_dismissals", "total_catches",
                "total_stumpings"),
}


def ranking_view(rankings: DataFrame, role: str) -> DataFrame:
    """The all-format ranking columns the board shows (order kept)."""
    return rankings.select(*RANKING_VIEW_COLUMNS[spec(role).name])


def country_view(country_stats: DataFrame, role: str) -> DataFrame:
    """The country columns the board shows."""
    return country_stats.select(*COUNTRY_VIEW_COLUMNS[spec(role).name])


def country_sorted(country_stats: DataFrame, role: str) -> DataFrame:
    """Country statistics by the role's primary column, NULL as 0."""
    from scorelake.operators.serve import COUNTRY_COLUMNS
    primary = COUNTRY_COLUMNS[spec(role).name][3]
    return country_stats.orderBy(_num(F.col(primary)).desc(), F.col("country"))

"""Role and format specifications.

Everything that differs between the three roles (batsmen, bowler, fielder)
and the three formats (ODI, T20, Test) is data in this module, so the
cleaning, aggregation and serving code is written once per step instead of
once per (role, format) pair.
"""

from __future__ import annotations

from dataclasses import dataclass, field

ROLES = ("batsmen", "bowler", "fielder")
FORMATS = ("ODI", "T20", "Test")
ALL = "All"

# Board order of formats (player header, per-format bars, best format).
BOARD_FORMAT_ORDER = ("Test", "ODI", "T20")
# Order in which the board loads its nine datasets; "first value" metrics
# (best innings / best match) take the value of the earliest dataset.
LOAD_FORMAT_ORDER = ("ODI", "T20", "Test")

# --- fixed values: team code -> country -----------------------------------
# Matching is by substring and the first key in this order wins, so the
# order is part of the semantics ("USA" contains "SA"; "AUS/ENG" is AUS).
# The spellings "Afganisthan" and "HongKonng" are kept as the source has them.
COUNTRY_CODES: tuple[tuple[str, str], ...] = (
    ("INDIA", "India"),
    ("BMUDA", "Bermuda"),
    ("SL", "Sri Lanka"),
    ("NZ", "New Zealand"),
    ("WI", "West Indies"),
    ("BDESH", "Bangladesh"),
    ("ZIM", "Zimbabwe"),
    ("AUS", "Australia"),
    ("AFG", "Afganisthan"),
    ("SA", "South Africa"),
    ("ENG", "England"),
    ("IRE", "Ireland"),
    ("PNG", "Papua New Guinea"),
    ("EAf", "Kenya"),
    ("PAK", "Pakistan"),
    ("NAM", "Namibia"),
    ("UAE", "United Arab Emirates"),
    ("HKG", "HongKonng"),
    ("NL", "Netherlands"),
    ("SCOT", "Scotland"),
    ("CAN", "Canada"),
    ("Afr/KENYA", "Kenya"),
    ("KENYA", "Kenya"),
    ("NEPAL", "Nepal"),
)
# --- end of fixed values ---------------------------------------------------

COUNTRIES = tuple(sorted({name for _, name in COUNTRY_CODES}))

# Board role names (the dashboard's tabs) per query role.
BOARD_ROLE = {"batsmen": "Batting", "bowler": "Bowling", "fielder": "Fielding"}


@dataclass(frozen=True)
class RoleSpec:
    """Everything role-specific, from raw header to board metrics."""

    name: str
    # raw header -> silver name (names not listed keep their header name)
    renames: dict[str, str]
    # raw headers dropped after renaming
    dropped: tuple[str, ...]
    # silver columns in storage order, with Spark SQL types; the first two
    # (full_name, country) and the last (format) are common to all roles
    silver: tuple[tuple[str, str], ...]
    # raw headers present per format (missing ones are NULL in the role frame)
    raw_by_format: dict[str, tuple[str, ...]]
    # columns of the all-format union view
    union_columns: tuple[str, ...]
    # serving projection per format: (silver column, output name)
    serve: dict[str, tuple[tuple[str, str], ...]]
    # board configuration (names are the serving output names)
    primary: str = ""
    metrics: tuple[str, ...] = ()
    kpis: tuple[str, ...] = ()
    profile: tuple[str, ...] = ()
    ranking_sort: tuple[str, ...] = ()
    ranking_columns: tuple[str, ...] = ()
    extra: dict = field(default_factory=dict)

    @property
    def silver_names(self) -> tuple[str, ...]:
        return tuple(n for n, _ in self.silver)

    @property
    def raw_columns(self) -> tuple[str, ...]:
        seen: list[str] = []
        for fmt in FORMATS:
            for c in self.raw_by_format[fmt]:
                if c not in seen:
                    seen.append(c)
        return tuple(seen)


_HEAD = (("full_name", "string"), ("country", "string"), ("years_active", "int"),
         ("matches_played", "int"), ("innings_played", "int"))
_COMMON_RENAMES = {"Mat": "matches_played", "Inns": "innings_played", "Ave": "average",
                   "SR": "strike_rate", "4s": "number_of_fours", "6s": "number_of_sixes",
                   "HS": "highest_score", "Span": "years_active"}

_BAT_ODI = ("Player", "Span", "Mat", "Inns", "NO", "Runs", "HS", "Ave", "BF", "SR", "100", "50", "0")

BATSMEN = RoleSpec(
    name="batsmen",
    renames={**_COMMON_RENAMES, "BF": "balls_faced", "100": "hundreds", "50": "fifties",
             "0": "ducks", "NO": "not_outs"},
    dropped=(),
    silver=_HEAD + (("not_outs", "int"), ("Runs", "int"), ("highest_score", "int"),
                    ("average", "float"), ("balls_faced", "int"), ("strike_rate", "float"),
                    ("hundreds", "int"), ("fifties", "int"), ("ducks", "int"),
                    ("number_of_fours", "int"), ("number_of_sixes", "int"),
                    ("format", "string")),
    raw_by_format={
        "ODI": _BAT_ODI,
        "T20": _BAT_ODI + ("4s", "6s"),
        "Test": tuple(c for c in _BAT_ODI if c not in ("BF", "SR")),
    },
    union_columns=("full_name", "country", "years_active", "matches_played", "innings_played",
                   "not_outs", "Runs", "highest_score", "average", "hundreds", "fifties",
                   "ducks", "format"),
    serve={
        "ODI": (("full_name", "full_name"), ("country", "country"), ("years_active", "years_active"),
                ("matches_played", "matches_played"), ("innings_played", "innings_played"),
                ("not_outs", "not_outs"), ("Runs", "runs"), ("highest_score", "highest_score"),
                ("average", "average"), ("balls_faced", "balls_faced"),
                ("strike_rate", "strike_rate"), ("hundreds", "hundreds"), ("fifties", "fifties"),
                ("ducks", "ducks"), ("format", "format")),
        "T20": (("full_name", "full_name"), ("country", "country"), ("years_active", "years_active"),
                ("matches_played", "matches_played"), ("innings_played", "innings_played"),
                ("not_outs", "not_outs"), ("Runs", "runs"), ("highest_score", "highest_score"),
                ("average", "average"), ("balls_faced", "balls_faced"),
                ("strike_rate", "strike_rate"), ("hundreds", "hundreds"), ("fifties", "fifties"),
                ("ducks", "ducks"), ("number_of_fours", "fours"), ("number_of_sixes", "sixes"),
                ("format", "format")),
        "Test": (("full_name", "full_name"), ("country", "country"), ("years_active", "years_active"),
                 ("matches_played", "matches_played"), ("innings_played", "innings_played"),
                 ("not_outs", "not_outs"), ("Runs", "runs"), ("highest_score", "highest_score"),
                 ("average", "average"), ("hundreds", "hundreds"), ("fifties", "fifties"),
                 ("ducks", "ducks"), ("format", "format")),
        "All": (("full_name", "full_name"), ("country", "country"), ("years_active", "years_active"),
                ("matches_played", "matches_played"), ("innings_played", "innings_played"),
                ("not_outs", "not_outs"), ("Runs", "runs"), ("highest_score", "highest_score"),
                ("average", "average"), ("hundreds", "hundreds"), ("fifties", "fifties"),
                ("ducks", "ducks"), ("format", "format")),
    },
    primary="runs",
    metrics=("runs", "average", "strike_rate", "hundreds", "fifties", "sixes"),
    kpis=("runs", "average", "strike_rate", "hundreds"),
    profile=("matches_played", "innings_played", "highest_score", "fifties", "ducks"),
    ranking_sort=("runs", "hundreds", "fifties", "matches_played"),
    ranking_columns=("full_name", "country", "matches_played", "runs", "hundreds", "fifties",
                     "average", "strike_rate"),
)

BOWLER = RoleSpec(
    name="bowler",
    renames={**_COMMON_RENAMES, "Wkts": "wickets", "Econ": "economy", "4": "four_wicket_hauls",
             "5": "five_wicket_hauls", "Mdns": "number_of_maidens"},
    dropped=(),
    silver=_HEAD + (("Balls", "int"), ("Overs", "int"), ("number_of_maidens", "int"),
                    ("Runs", "int"), ("wickets", "int"), ("BBI", "string"), ("BBM", "string"),
                    ("average", "float"), ("economy", "float"), ("strike_rate", "float"),
                    ("four_wicket_hauls", "int"), ("five_wicket_hauls", "int"), ("10", "int"),
                    ("format", "string")),
    raw_by_format={
        "ODI": ("Player", "Span", "Mat", "Inns", "Balls", "Runs", "Wkts", "BBI", "Ave", "Econ",
                "SR", "4", "5"),
        "T20": ("Player", "Span", "Mat", "Inns", "Overs", "Mdns", "Runs", "Wkts", "BBI", "Ave",
                "Econ", "SR", "4", "5"),
        "Test": ("Player", "Span", "Mat", "Inns", "Balls", "Runs", "Wkts", "BBI", "BBM", "Ave",
                 "Econ", "SR", "5", "10"),
    },
    union_columns=("full_name", "country", "years_active", "matches_played", "innings_played",
                   "Runs", "wickets", "BBI", "average", "economy", "strike_rate",
                   "five_wicket_hauls", "format"),
    serve={
        "ODI": (("full_name", "full_name"), ("country", "country"), ("years_active", "years_active"),
                ("matches_played", "matches_played"), ("innings_played", "innings_played"),
                ("Balls", "balls"), ("Runs", "runs_conceded"), ("wickets", "wickets"),
                ("BBI", "best_innings"), ("average", "average"), ("economy", "economy"),
                ("strike_rate", "strike_rate"), ("four_wicket_hauls", "four_wicket_hauls"),
                ("five_wicket_hauls", "five_wicket_hauls"), ("format", "format")),
        "T20": (("full_name", "full_name"), ("country", "country"), ("years_active", "years_active"),
                ("matches_played", "matches_played"), ("innings_played", "innings_played"),
                ("Overs", "balls"), ("number_of_maidens", "maidens"), ("Runs", "runs_conceded"),
                ("wickets", "wickets"), ("BBI", "best_innings"), ("average", "average"),
                ("economy", "economy"), ("strike_rate", "strike_rate"),
                ("four_wicket_hauls", "four_wicket_hauls"),
                ("five_wicket_hauls", "five_wicket_hauls"), ("format", "format")),
        "Test": (("full_name", "full_name"), ("country", "country"), ("years_active", "years_active"),
                 ("matches_played", "matches_played"), ("innings_played", "innings_played"),
                 ("Balls", "balls"), ("Runs", "runs_conceded"), ("wickets", "wickets"),
                 ("BBI", "best_innings"), ("BBM", "best_match"), ("average", "average"),
                 ("economy", "economy"), ("strike_rate", "strike_rate"),
                 ("five_wicket_hauls", "five_wicket_hauls"), ("10", "ten_wicket_hauls"),
                 ("format", "format")),
        "All": (("full_name", "full_name"), ("country", "country"), ("years_active", "years_active"),
                ("matches_played", "matches_played"), ("innings_played", "innings_played"),
                ("Runs", "runs_conceded"), ("wickets", "wickets"), ("BBI", "best_innings"),
                ("average", "average"), ("economy", "economy"), ("strike_rate", "strike_rate"),
                ("five_wicket_hauls", "five_wicket_hauls"), ("format", "format")),
    },
    primary="wickets",
    metrics=("wickets", "average", "economy", "strike_rate", "five_wicket_hauls",
             "ten_wicket_hauls"),
    kpis=("wickets", "average", "economy", "five_wicket_hauls"),
    profile=("matches_played", "innings_played", "best_innings", "best_match", "runs_conceded"),
    ranking_sort=("wickets", "five_wicket_hauls", "matches_played"),
    ranking_columns=("full_name", "country", "matches_played", "wickets", "average", "economy",
                     "strike_rate"),
)

_FIELD_RAW = ("Player", "Span", "Mat", "Inns", "Dis", "Ct", "St", "Ct Wk", "Ct Fi", "MD", "D/I")
_FIELD_SERVE = (("full_name", "full_name"), ("country", "country"),
                ("years_active", "years_active"), ("matches_played", "matches_played"),
                ("innings_played", "innings_played"), ("dismissals", "dismissals"),
                ("catches", "catches"), ("stumpings", "stumpings"),
                ("catch_wickets", "catch_wickets"), ("format", "format"))

FIELDER = RoleSpec(
    name="fielder",
    renames={**_COMMON_RENAMES, "Dis": "dismissals", "Ct": "catches", "St": "stumpings",
             "Ct Wk": "catch_wickets"},
    dropped=("Ct Fi", "MD", "D/I"),
    silver=_HEAD + (("dismissals", "int"), ("catches", "int"), ("stumpings", "int"),
                    ("catch_wickets", "int"), ("format", "string")),
    raw_by_format={f: _FIELD_RAW for f in FORMATS},
    union_columns=("full_name", "country", "years_active", "matches_played", "innings_played",
                   "dismissals", "catches", "stumpings", "catch_wickets", "format"),
    serve={f: _FIELD_SERVE for f in FORMATS + (ALL,)},
    primary="dismissals",
    metrics=("dismissals", "catches", "stumpings", "catch_wickets", "matches_played"),
    kpis=("dismissals", "catches", "stumpings", "catch_wickets"),
    profile=("matches_played", "innings_played", "years_active"),
    ranking_sort=("catches", "catch_wickets", "stumpings", "matches_played"),
    ranking_columns=("full_name", "country", "matches_played", "dismissals", "catches",
                     "stumpings", "catch_wickets"),
)

SPECS = {s.name: s for s in (BATSMEN, BOWLER, FIELDER)}

# Board metric kinds (how one player's rows collapse to one value).
MEAN_METRICS = ("average", "strike_rate", "economy")
MAX_METRICS = ("highest_score",)
FIRST_METRICS = ("best_innings", "best_match")
# On the bowling board these rate metrics rank ascending (lower is better).
ASCENDING_BOWLING_METRICS = ("average", "economy", "strike_rate")


def spec(role: str) -> RoleSpec:
    """Role spec, with the serving layer's argument check."""
    if role not in SPECS:
        raise ValueError(f"invalid role {role!r}; expected one of {ROLES}")
    return SPECS[role]


def check_format(fmt: str, allow_all: bool = True) -> str:
    allowed = FORMATS + ((ALL,) if allow_all else ())
    if fmt not in allowed:
        raise ValueError(f"invalid format {fmt!r}; expected one of {allowed}")
    return fmt

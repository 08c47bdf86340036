"""The fixed values that the oracle's SQL is made of, written out apart from the library's own.

Nothing here is imported from the library, so a wrong rename or a swapped code
there shows as a difference.
"""

from __future__ import annotations

from types import SimpleNamespace

# --- fixed values ------------------------------------------------------------
ROLES = ("batsmen", "bowler", "fielder")
FORMATS = ("ODI", "T20", "Test")
BOARD_FORMAT_ORDER = ("Test", "ODI", "T20")
LOAD_FORMAT_ORDER = ("ODI", "T20", "Test")
BOARD_ROLE = {"batsmen": "Batting", "bowler": "Bowling", "fielder": "Fielding"}
MEAN_METRICS = ("average", "strike_rate", "economy")
MAX_METRICS = ("highest_score",)
FIRST_METRICS = ("best_innings", "best_match")

# team codes in match order
COUNTRY_CODES = tuple(pair.split("=") for pair in (
    "INDIA=India", "BMUDA=Bermuda", "SL=Sri Lanka", "NZ=New Zealand", "WI=West Indies", "BDESH=Bangladesh",
    "ZIM=Zimbabwe", "AUS=Australia", "AFG=Afganisthan", "SA=South Africa", "ENG=England", "IRE=Ireland",
    "PNG=Papua New Guinea", "EAf=Kenya", "PAK=Pakistan", "NAM=Namibia", "UAE=United Arab Emirates", "HKG=HongKonng",
    "NL=Netherlands", "SCOT=Scotland", "CAN=Canada", "Afr/KENYA=Kenya", "KENYA=Kenya", "NEPAL=Nepal"))

# raw headers of each file
RAW = {
    "batsmen": {"ODI": "Player|Span|Mat|Inns|NO|Runs|HS|Ave|BF|SR|100|50|0",
                "T20": "Player|Span|Mat|Inns|NO|Runs|HS|Ave|BF|SR|100|50|0|4s|6s",
                "Test": "Player|Span|Mat|Inns|NO|Runs|HS|Ave|100|50|0"},
    "bowler": {"ODI": "Player|Span|Mat|Inns|Balls|Runs|Wkts|BBI|Ave|Econ|SR|4|5",
               "T20": "Player|Span|Mat|Inns|Overs|Mdns|Runs|Wkts|BBI|Ave|Econ|SR|4|5",
               "Test": "Player|Span|Mat|Inns|Balls|Runs|Wkts|BBI|BBM|Ave|Econ|SR|5|10"},
    "fielder": dict.fromkeys(FORMATS, "Player|Span|Mat|Inns|Dis|Ct|St|Ct Wk|Ct Fi|MD|D/I"),
}

# silver columns: name, type, and the raw header where it has another name
SILVER = {
    "batsmen": """full_name string; country string; years_active int Span; matches_played int Mat;
        innings_played int Inns; not_outs int NO; Runs int; highest_score int HS; average float Ave;
        balls_faced int BF; strike_rate float SR; hundreds int 100; fifties int 50; ducks int 0;
        number_of_fours int 4s; number_of_sixes int 6s; format string""",
    "bowler": """full_name string; country string; years_active int Span; matches_played int Mat;
        innings_played int Inns; Balls int; Overs int; number_of_maidens int Mdns; Runs int; wickets int Wkts;
        BBI string; BBM string; average float Ave; economy float Econ; strike_rate float SR;
        four_wicket_hauls int 4; five_wicket_hauls int 5; 10 int; format string""",
    "fielder": """full_name string; country string; years_active int Span; matches_played int Mat;
        innings_played int Inns; dismissals int Dis; catches int Ct; stumpings int St; catch_wickets int Ct Wk;
        format string""",
}

# columns of the unions of the formats
UNION = {
    "batsmen": "full_name country years_active matches_played innings_played not_outs Runs highest_score average "
               "hundreds fifties ducks format",
    "bowler": "full_name country years_active matches_played innings_played Runs wickets BBI average economy "
              "strike_rate five_wicket_hauls format",
    "fielder": "full_name country years_active matches_played innings_played dismissals catches stumpings "
               "catch_wickets format",
}

# what the player queries select, with the name it is given
_WHO = "full_name country years_active matches_played innings_played "
SERVE = {
    "batsmen": {
        "ODI": _WHO + "not_outs Runs=runs highest_score average balls_faced strike_rate hundreds fifties ducks format",
        "T20": _WHO + "not_outs Runs=runs highest_score average balls_faced strike_rate hundreds fifties ducks "
                      "number_of_fours=fours number_of_sixes=sixes format",
        "Test": _WHO + "not_outs Runs=runs highest_score average hundreds fifties ducks format",
        "All": _WHO + "not_outs Runs=runs highest_score average hundreds fifties ducks format"},
    "bowler": {
        "ODI": _WHO + "Balls=balls Runs=runs_conceded wickets BBI=best_innings average economy strike_rate "
                      "four_wicket_hauls five_wicket_hauls format",
        "T20": _WHO + "Overs=balls number_of_maidens=maidens Runs=runs_conceded wickets BBI=best_innings average "
                      "economy strike_rate four_wicket_hauls five_wicket_hauls format",
        "Test": _WHO + "Balls=balls Runs=runs_conceded wickets BBI=best_innings BBM=best_match average economy "
                       "strike_rate five_wicket_hauls 10=ten_wicket_hauls format",
        "All": _WHO + "Runs=runs_conceded wickets BBI=best_innings average economy strike_rate five_wicket_hauls "
                      "format"},
    "fielder": dict.fromkeys(FORMATS + ("All",), _WHO + "dismissals catches stumpings catch_wickets format"),
}

# what the country queries select
COUNTRY_COLUMNS = {
    "batsmen": ("country", "format", "number_of_players", "total_runs", "average_batting_average",
                "average_strike_rate", "total_hundreds", "total_fifties", "total_ducks"),
    "bowler": ("country", "format", "number_of_players", "total_wickets", "runs_conceded", "average_bowling_average",
               "average_strike_rate", "average_economy", "total_four_wicket_houls", "total_five_wicket_hauls"),
    "fielder": ("country", "format", "number_of_players", "total_dismissals", "total_catches", "total_stumpings"),
}

# metrics of the board, the primary one first of its line
BOARD = {
    "batsmen": ("runs", "runs average strike_rate hundreds fifties sixes", "runs average strike_rate hundreds",
                "matches_played innings_played highest_score fifties ducks"),
    "bowler": ("wickets", "wickets average economy strike_rate five_wicket_hauls ten_wicket_hauls",
               "wickets average economy five_wicket_hauls",
               "matches_played innings_played best_innings best_match runs_conceded"),
    "fielder": ("dismissals", "dismissals catches stumpings catch_wickets matches_played",
                "dismissals catches stumpings catch_wickets", "matches_played innings_played years_active"),
}

# a format's ranking on the board: its order (descending) and its columns
RANKING_SORT = {"batsmen": "runs hundreds fifties matches_played", "bowler": "wickets five_wicket_hauls matches_played",
                "fielder": "catches catch_wickets stumpings matches_played"}
RANKING_COLUMNS = {
    "batsmen": "full_name country matches_played runs hundreds fifties average strike_rate",
    "bowler": "full_name country matches_played wickets average economy strike_rate",
    "fielder": "full_name country matches_played dismissals catches stumpings catch_wickets",
}

# what the board shows of the all-format rankings and of the country tables
RANKING_VIEW_COLUMNS = {
    "batsmen": ("full_name", "country", "formats_played", "total_matches", "total_runs", "total_centuries",
                "total_fifties", "total_average"),
    "bowler": ("full_name", "country", "formats_played", "total_matches", "total_wickets", "average_bowling_average",
               "average_bowling_economy"),
    "fielder": ("full_name", "country", "formats_played", "total_catches", "total_wicket_keeper_catches",
                "total_stumpings"),
}
COUNTRY_VIEW_COLUMNS = {
    "batsmen": ("country", "number_of_players", "total_runs", "average_batting_average", "average_strike_rate",
                "total_hundreds", "total_fifties", "total_ducks"),
    "bowler": ("country", "number_of_players", "total_wickets", "runs_conceded", "average_bowling_average",
               "average_economy", "total_five_wicket_hauls"),
    "fielder": ("country", "number_of_players", "total_dismissals", "total_catches", "total_stumpings"),
}
# --- end of fixed values -------------------------------------------------------


def spec(role: str) -> SimpleNamespace:
    """The values of a role by name."""
    silver = [line.split(None, 2) for line in SILVER[role].split(";")]
    primary, metrics, kpis, profile = BOARD[role]
    raw_by_format = {f: tuple(h.split("|")) for f, h in RAW[role].items()}
    return SimpleNamespace(
        name=role, raw_by_format=raw_by_format,
        raw_columns=tuple(dict.fromkeys(c for f in FORMATS for c in raw_by_format[f])),
        renames={c[2].strip(): c[0] for c in silver if len(c) == 3},
        silver=tuple((c[0], c[1]) for c in silver), silver_names=tuple(c[0] for c in silver),
        union_columns=tuple(UNION[role].split()),
        serve={f: tuple((c.split("=")[0], c.split("=")[-1]) for c in text.split()) for f, text in SERVE[role].items()},
        primary=primary, metrics=tuple(metrics.split()), kpis=tuple(kpis.split()), profile=tuple(profile.split()),
        ranking_sort=tuple(RANKING_SORT[role].split()), ranking_columns=tuple(RANKING_COLUMNS[role].split()))

"""Player text -> full name, team code, country."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scorelake.functions.names import country_of, full_name_of, has_known_code, team_code_of
from scorelake.specs import COUNTRY_CODES


def spec_parse(player):
    """The semantics in plain Python: split on single spaces (empties kept)."""
    tokens = player.split(" ")
    name = " ".join(t for t in tokens if "(" not in t)
    bracketed = [t for t in tokens if "(" in t]
    code = bracketed[-1][1:-1] if bracketed else ""
    country = next((c for k, c in COUNTRY_CODES if k in code), None)
    return name, code, country


CASES = [
    "SR Tendulkar (INDIA)", "Y Khan (ICC/PAK)", "X (USA)", "Z Q (ICC World XI)",
    "A  B (AUS/ENG)", "M (SL) (WI)", "NoParen", "", "(", "A (", "()", "(X) A B",
    "A (B) (", "T (Afr/KENYA)", "K (EAf)", "lower (india)", "P (NEPAL) Jr", " lead (NZ)",
    "trail (NZ) ", "J  (HKG)  x", "(ENG)", "Q (PNG/SCOT)", "R (ICC/IRE/NL)",
]


def _run(spark, players):
    df = spark.createDataFrame([(p,) for p in players], "p string")
    p = F.col("p")
    out = df.select("p", full_name_of(p).alias("n"), team_code_of(p).alias("c"))
    out = out.select("p", "n", "c", country_of(F.col("c")).alias("k"),
                     has_known_code(F.col("c")).alias("known"))
    return {r.p: (r.n, r.c, r.k, r.known) for r in out.collect()}


def test_cases(spark):
    got = _run(spark, CASES)
    for p in CASES:
        n, c, k = spec_parse(p)
        assert got[p][:3] == (n, c, k), p
        assert got[p][3] == (k is not None), p


def test_documented_examples(spark):
    got = _run(spark, CASES)
    assert got["SR Tendulkar (INDIA)"][0::2] == ("SR Tendulkar", "India")
    assert got["Y Khan (ICC/PAK)"][2] == "Pakistan"
    assert got["X (USA)"][2] == "South Africa"  # "USA" contains "SA"
    assert got["Z Q (ICC World XI)"][2] is None
    assert got["A  B (AUS/ENG)"][0::2] == ("A  B", "Australia")  # double space kept
    assert got["M (SL) (WI)"][2] == "West Indies"  # the last bracket wins
    assert got["NoParen"][2] is None


def test_null_player(spark):
    df = spark.createDataFrame([(None,)], "p string")
    r = df.select(team_code_of(F.col("p")).alias("c")).select(
        has_known_code(F.col("c")).alias("k")).collect()[0]
    assert not r.k  # NULL: filtered out by C5


_tok = st.sampled_from(["A", "Bb", "", "(INDIA)", "(ICC/PAK)", "(X", "Y)", "(", ")", "(USA)",
                        "(SL", "WI)", "(AUS/ENG)", "NZ", "(Afr/KENYA)", "x(y", "(HKG)z"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(_tok, min_size=1, max_size=6).map(" ".join), min_size=1, max_size=20))
def test_property_matches_spec(spark, players):
    got = _run(spark, players)
    for p in set(players):
        n, c, k = spec_parse(p)
        assert got[p][:3] == (n, c, k), p
        assert got[p][3] == (k is not None), p

"""Silver cleaning on literal raw rows."""

import pytest
from pyspark.sql import functions as F

from scorelake.operators.clean import clean, clean_format, format_columns, role_frame, tag_format
from scorelake.specs import spec

BAT_T20 = ["_c0", "Player", "Span", "Mat", "Inns", "NO", "Runs", "HS", "Ave", "BF", "SR", "100",
           "50", "0", "4s", "6s", "Unnamed: 16"]


def _bat_t20(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in BAT_T20))


def test_batting_t20_row(spark):
    df = _bat_t20(spark, [
        ("0", "V Kohli (INDIA)", "2010-2024", "117", "109", "31", "4037", "122*", "51.75",
         "2922", "138.15", "1", "37", "7", "361", "124", "x"),
        ("1", "Nobody (XYZ)", "2010-2011", "1", "1", "0", "1", "1", "1", "1", "1", "0", "0", "0",
         "0", "0", "x"),
    ])
    out = clean_format(df, "batsmen", "T20")
    assert out.columns == format_columns("batsmen", "T20")
    rows = out.collect()
    assert len(rows) == 1  # unknown team dropped
    r = rows[0]
    assert (r.full_name, r.country, r.years_active, r.highest_score, r.format) == \
        ("V Kohli", "India", 14, 122, "T20")
    assert r.number_of_fours == 361 and r.number_of_sixes == 124
    assert abs(r.average - 51.75) < 1e-4


def test_silver_types_follow_contract(spark):
    for role in ("batsmen", "bowler", "fielder"):
        s = spec(role)
        cols = list(s.raw_by_format["ODI"])
        df = spark.createDataFrame([tuple(["A (AUS)"] + ["1"] * (len(cols) - 1))],
                                   ", ".join(f"`{c}` string" for c in cols))
        out = clean(tag_format(df, "ODI"), role)
        got = [(f.name, f.dataType.simpleString()) for f in out.schema.fields]
        assert got == list(s.silver), role


def test_dedup_after_casts(spark):
    # rows that differ only in text that does not parse merge
    df = _bat_t20(spark, [
        ("0", "A (SL)", "2000-2001", "1", "1", "0", "5", "5", "-", "5", "x", "0", "0", "0", "0", "0", "u"),
        ("1", "A (SL)", "2000-2001", "1", "1", "0", "5", "5", "?", "5", "y", "0", "0", "0", "0", "0", "v"),
    ])
    assert clean_format(df, "batsmen", "T20").count() == 1


def test_role_frame_missing_columns_null(spark):
    t20 = _bat_t20(spark, [("0", "A (SL)", "2000-2001", "1", "1", "0", "5", "5", "5.00", "5",
                            "100.00", "0", "0", "0", "2", "1", "u")])
    test_cols = list(spec("batsmen").raw_by_format["Test"])
    test = spark.createDataFrame([tuple(["B (NZ)", "1999-2000"] + ["2"] * (len(test_cols) - 2))],
                                 ", ".join(f"`{c}` string" for c in test_cols))
    frame = role_frame({"T20": t20, "Test": test})
    out = {r.format: r for r in clean(frame, "batsmen").collect()}
    assert out["Test"].balls_faced is None and out["Test"].number_of_sixes is None
    assert out["T20"].number_of_sixes == 1


def test_bowling_overs_and_names(spark):
    cols = list(spec("bowler").raw_by_format["T20"])
    vals = {"Player": "R Khan (AFG)", "Span": "2015-2024", "Overs": "12.3", "BBI": "5/3"}
    df = spark.createDataFrame([tuple(vals.get(c, "4") for c in cols)],
                               ", ".join(f"`{c}` string" for c in cols))
    r = clean_format(df, "bowler", "T20").collect()[0]
    assert r.Overs == 75 and r.country == "Afganisthan" and r.BBI == "5/3"
    assert r.number_of_maidens == 4 and r.four_wicket_hauls == 4


def test_fielding_drops_extra_columns(spark):
    cols = list(spec("fielder").raw_by_format["ODI"])
    df = spark.createDataFrame([tuple("C (ENG)" if c == "Player" else "3" for c in cols)],
                               ", ".join(f"`{c}` string" for c in cols))
    out = clean_format(df, "fielder", "ODI")
    assert not {"Ct Fi", "MD", "D/I"} & set(out.columns)
    assert out.collect()[0].catch_wickets == 3


def test_missing_player_column_rejected(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(ValueError):
        clean(df.withColumn("format", F.lit("ODI")), "batsmen")


def test_bad_role_and_format(spark):
    df = spark.createDataFrame([("x",)], "Player string")
    with pytest.raises(ValueError):
        clean_format(df, "keeper", "ODI")
    with pytest.raises(ValueError):
        tag_format(df, "T10")

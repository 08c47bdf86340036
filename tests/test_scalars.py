"""C8-C10, C13 and decimal rounding on literal values."""

from pyspark.sql import functions as F

from scorelake.functions.scalars import (
    balls_from_overs, highest_score_text, round_half_up, safe_cast, span_years)


def _one(spark, fn, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_highest_score(spark):
    got = _one(spark, lambda c: safe_cast(highest_score_text(c), "int"),
               ["200*", "183", "-", None, "1*2", "*"])
    # '*' anywhere drops the last character, kept as the source does
    assert got == [200, 183, None, None, None, None]  # "1*2" -> "1*" -> NULL


def test_span_years(spark):
    got = _one(spark, span_years, ["1989-2012", "2001-2001", "2005", "a-b", None, "1990-", " 1990-1995"])
    assert got == [23, 0, None, None, None, None, 5]


def test_overs_to_balls(spark):
    got = _one(spark, balls_from_overs, ["12.3", "0.5", "12", "-", None, "7.0", "3.4.5"])
    assert got == [75, 5, 0, 0, None, 42, 22]  # text without a dot is 0


def test_lenient_casts(spark):
    assert _one(spark, lambda c: safe_cast(c, "int"), ["3", "3.5", "-", None, " 7", "x"]) == \
        [3, None, None, None, 7, None]
    got = _one(spark, lambda c: safe_cast(c, "float"), ["40.95", "-", "1e2"])
    assert abs(got[0] - 40.95) < 1e-5 and got[1] is None and got[2] == 100.0


def test_round_half_up_ties(spark):
    got = _one(spark, round_half_up, [1.005, 1.015, 2.675, -1.005, None], "double")
    # ties round away from zero on the printed decimal value
    assert got == [1.01, 1.02, 2.68, -1.01, None]

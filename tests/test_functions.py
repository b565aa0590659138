"""Scalar expressions: the traps listed for binning, codes, dates, rounding."""

import datetime as dt

from pyspark.sql import functions as F

from dealcast.functions import periods as P
from dealcast.functions import scalar as S


def _one(spark, expr, value, typ="double"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_value_band_right_closed_lowest_included(spark):
    assert _one(spark, S.value_band, 0.0) == "Small"
    assert _one(spark, S.value_band, 1000.0) == "Small"
    assert _one(spark, S.value_band, 1000.01) == "Medium"
    assert _one(spark, S.value_band, 50000.0) == "Very Large"
    assert _one(spark, S.value_band, 50000.5) == "Enterprise"
    assert _one(spark, S.value_band, -1.0) is None
    assert _one(spark, S.value_band, None) is None


def test_probability_band_excludes_zero(spark):
    assert _one(spark, S.probability_band, 0.0) is None
    assert _one(spark, S.probability_band, 0.3) == "Low (0-30%)"
    assert _one(spark, S.probability_band, 0.31) == "Medium (30-60%)"
    assert _one(spark, S.probability_band, 1.0) == "Very High (80%+)"


def test_cycle_band(spark):
    assert _one(spark, S.cycle_band, 0, "int") == "Quick"
    assert _one(spark, S.cycle_band, 30, "int") == "Quick"
    assert _one(spark, S.cycle_band, 31, "int") == "Short"
    assert _one(spark, S.cycle_band, 400, "int") == "Very Long"


def test_weekday_monday_zero_and_quarter(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 4, 7),)], "d date")
    rows = df.select(*[c.alias(n) for n, c in S.date_parts("d", "e").items()]).collect()
    assert rows[0]["e_day_of_week"] == 0 and rows[0]["e_month"] == 1 and rows[0]["e_quarter"] == 1
    assert rows[1]["e_quarter"] == 2 and rows[1]["e_day_of_week"] == 6


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.0625,), (0.0635,), (2.5,)], "x double")
    got = [r[0] for r in df.select(S.round_half_even("x", 3)).collect()]
    assert got[0] == 0.062 and got[2] == 2.5
    assert [r[0] for r in df.select(S.round_half_even("x", 0)).collect()][2] == 2.0


def test_stage_order_and_flags(spark):
    df = spark.createDataFrame([("Won",), ("Lost",), ("Engaging",), ("Prospecting",), (None,)], "deal_stage string")
    out = df.select(S.stage_order().alias("o"), *[c.alias(n) for n, c in S.stage_flags().items()]).collect()
    assert [r["o"] for r in out] == [4, 0, 2, 1, None]
    assert [r["is_closed"] for r in out] == [1, 1, 0, 0, 0]
    assert [r["is_open"] for r in out] == [0, 0, 1, 1, 1]


def test_safe_ratio_no_division_by_zero(spark):
    df = spark.createDataFrame([(10.0, 0), (10.0, None), (10.0, 4)], "v double, c int")
    got = [r[0] for r in df.select(S.safe_ratio("v", "c", 0.0)).collect()]
    assert got == [0.0, 0.0, 2.5]


def test_risk_size_and_formats(spark):
    df = spark.createDataFrame([(0.75, 6000.0), (0.5, 2000.0), (0.1, 10.0)], "p double, v double")
    out = df.select(S.risk_level("p").alias("r"), S.deal_size("v").alias("s"),
                    S.currency("v").alias("c"), S.percent("p").alias("pc")).collect()
    assert [r["r"] for r in out] == ["Low", "Medium", "High"]
    assert [r["s"] for r in out] == ["Large", "Medium", "Small"]
    assert out[0]["c"] == "$6,000" and out[0]["pc"] == "75.0%"


def test_period_arithmetic(spark):
    df = spark.createDataFrame([("2024-01",), ("2024-13",)], "p string")
    r = df.select(P.next_period("p").alias("n"), P.previous_period("p").alias("prev"),
                  P.is_valid_period("p").alias("ok"), P.period_end("p").alias("end"),
                  P.period_range("p", 3).alias("rng")).collect()
    assert r[0]["n"] == "2024-02" and r[0]["prev"] == "2023-12" and r[0]["ok"] is True
    assert r[0]["end"] == dt.date(2024, 1, 31) and r[0]["rng"] == ["2024-01", "2024-02", "2024-03"]
    assert r[1]["ok"] is False


def test_calendar_labels(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 2),)], "d date")
    r = df.select(*[c.alias(n) for n, c in S.calendar_labels("d", "e").items()]).first()
    assert r["e_month_name"] == "December" and r["e_day_name"] == "Monday"
    assert r["e_is_quarter_end"] == 1 and r["e_is_december"] == 1

"""Scalar expressions and statistics on hand-made rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from wattline.functions import forecast as FF
from wattline.functions import physics as P
from wattline.functions import stats as S
from wattline.functions.calendar import add_calendar_features


def test_wind_speed_bins_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 3.0, 3.1, 8.0, 25.0, 100.0, 101.0)], "wind_speed double")
    got = [r[0] for r in df.select(P.wind_speed_category("wind_speed", None)).collect()]
    assert got == [None, "low", "moderate", "moderate", "very_high", "extreme", None]


def test_percentiles_and_constant_corr(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0), (9.0, 5.0)], "x double, c double")
    q = df.select(F.percentile("x", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))).first()[0]
    assert q == [pytest.approx(1.3), pytest.approx(3.0), pytest.approx(7.5)]
    assert df.select(S.pearson("x", "c")).first()[0] is None
    assert df.select(S.pearson("x", "x")).first()[0] == pytest.approx(1.0)


def test_calendar_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 13), ), (dt.datetime(2024, 1, 6, 0),)], "timestamp timestamp_ntz")
    rows = add_calendar_features(df).orderBy("timestamp").collect()
    assert (rows[0]["weekday"], rows[0]["is_weekend"], rows[0]["hour"]) == (0, 0, 13)
    assert (rows[1]["weekday"], rows[1]["is_weekend"]) == (5, 1)
    assert rows[0]["hour_sin"] == pytest.approx(math.sin(2 * math.pi * 13 / 24))


def test_clear_sky_index_rules(spark):
    df = spark.createDataFrame([("solar", 500.0, 12, 1), ("solar", 100.0, 3, 1), ("solar", 50.0, 18, 1), ("wind", 500.0, 12, 1)],
                               "plant_type string, surface_solar_radiation_downwards double, hour int, day_of_year int")
    got = [r[0] for r in df.select(P.clear_sky_index()).collect()]
    clear_noon = 1000 * (1 + 0.033 * math.cos(2 * math.pi / 365))
    assert got[0] == pytest.approx(500 / clear_noon)
    assert got[1] == 2.0          # zero denominator -> 1, then clipped to 2
    assert got[2] == 2.0          # sin(pi) is 1.2e-16, not 0: index saturates
    assert got[3] is None


def test_clip_keeps_nulls(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (70.0,)], "t double")
    assert [r[0] for r in df.select(P.clip("t", -10.0, 60.0)).collect()] == [None, -5.0, 60.0]


def test_wind_curve_and_pv(spark):
    df = spark.createDataFrame([(2.0, 100.0), (7.5, 100.0), (12.0, 100.0), (20.0, 100.0), (26.0, 100.0)], "wind_speed double, capacity_mw double")
    got = [r[0] for r in df.select(P.wind_power_curve()).collect()]
    assert got[0] == 0.0 and got[-1] == 0.0 and got[2] == pytest.approx(100.0) and got[3] == 100.0
    assert got[1] == pytest.approx(100.0 * (7.5 ** 3 - 27) / (1728 - 27))
    pv = spark.createDataFrame([(1000.0, 25.0, 0.0, 500.0), (0.0, 25.0, 0.0, 500.0)],
                               "surface_solar_radiation_downwards double, temperature_2m double, total_cloud_cover double, capacity_mw double")
    vals = [r[0] for r in pv.select(P.pv_expected_power()).collect()]
    assert vals == [pytest.approx(0.22), 0.0]


def test_round_half_even_and_confidence(spark):
    df = spark.createDataFrame([(2.345, 5.0), (2.355, 15.0), (0.125, 25.0)], "x double, r double")
    rows = df.select(FF.round_half_even("x", 2).alias("x"), FF.confidence_level("r").alias("c")).collect()
    assert [r["x"] for r in rows] == [2.34, 2.36, 0.12]
    assert [r["c"] for r in rows] == ["High", "Medium", "Low"]


def test_crps_matches_closed_form(spark):
    y, mu, sigma = 1.3, 1.0, 0.7
    z = (y - mu) / sigma
    exact = sigma * (z * math.erf(z / math.sqrt(2)) + 2 * math.exp(-z * z / 2) / math.sqrt(2 * math.pi) - 1 / math.sqrt(math.pi))
    df = spark.createDataFrame([(y, mu, sigma)], "y double, mu double, s double")
    assert df.select(S.crps_gaussian("y", "mu", "s")).first()[0] == pytest.approx(exact, abs=1e-6)

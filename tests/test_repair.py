"""Interpolation / fill semantics on hand-made series, and bucket-carry
equivalence (many tiny buckets == one bucket)."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import hourly
from wattline.operators.repair import fill_limited, interpolate, repair_missing

N = None
SERIES = [N, 1, N, N, N, 9, 10, N, N, N, 14, 15, N, N]
EXPECT_2 = [N, 1, 3, 5, N, 9, 10, 11, 12, N, 14, 15, 15, 15]
EXPECT_6 = [N, 1, 3, 5, 7, 9, 10, 11, 12, 13, 14, 15, 15, 15]


def _frame(spark, values, plant="p", start="2024-01-01 00:00:00", step_hours=1):
    import datetime as dt
    t0 = dt.datetime.fromisoformat(start)
    rows = [(plant, t0 + dt.timedelta(hours=i * step_hours), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "plant_name string, timestamp timestamp_ntz, x double")


def _vals(df, col="x"):
    return [r[col] for r in df.orderBy("plant_name", "timestamp").collect()]


@pytest.mark.parametrize("limit,expected", [(2, EXPECT_2), (6, EXPECT_6)])
@pytest.mark.parametrize("bucket_hours", [720, 3, 1])
def test_interpolate_time_fixture(spark, limit, expected, bucket_hours):
    out = interpolate(_frame(spark, SERIES), ["x"], limit=limit, method="time", bucket_hours=bucket_hours)
    got = _vals(out)
    for g, e in zip(got, expected):
        assert (g is None and e is None) or (g is not None and e is not None and abs(g - e) < 1e-9), (got, expected)


def test_interpolate_linear_matches_time_on_regular_grid(spark):
    a = _vals(interpolate(_frame(spark, SERIES), ["x"], limit=6, method="linear", bucket_hours=2))
    assert a == [None if v is None else pytest.approx(v) for v in EXPECT_6]


def test_interpolate_time_uses_elapsed_time(spark):
    import datetime as dt
    t = [dt.datetime(2024, 1, 1, 0), dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 4)]
    df = spark.createDataFrame([("p", t[0], 0.0), ("p", t[1], None), ("p", t[2], 8.0)],
                               "plant_name string, timestamp timestamp_ntz, x double")
    assert _vals(interpolate(df, ["x"], method="time"))[1] == pytest.approx(2.0)
    assert _vals(interpolate(df, ["x"], method="linear"))[1] == pytest.approx(4.0)


def test_ffill_bfill_limits(spark):
    vals = [1, N, N, N, N, 6]
    out = _vals(fill_limited(_frame(spark, vals), ["x"], ffill=2, bfill=None, bucket_hours=1))
    assert out == [1, 1, 1, N, N, 6]
    out = _vals(fill_limited(_frame(spark, vals), ["x"], ffill=None, bfill=1, bucket_hours=1))
    assert out == [1, N, N, N, 6, 6]
    out = _vals(fill_limited(_frame(spark, vals), ["x"], ffill=2, bfill=1, bucket_hours=2))
    assert out == [1, 1, 1, N, 6, 6]


def _pandas_chain(s: pd.Series, limit=6, fill=24):
    s = s.interpolate(method="time", limit=limit)
    s = s.ffill(limit=fill)
    return s.bfill(limit=fill)


def test_repair_chain_matches_pandas_on_random_gaps(spark):
    rnd = random.Random(7)
    n = 400
    ts = hourly(n=n)
    vals = []
    i = 0
    while i < n:
        if rnd.random() < 0.08:
            gap = rnd.choice([1, 3, 7, 20, 31, 60])
            vals += [None] * gap
            i += gap
        else:
            vals.append(rnd.uniform(0, 100))
            i += 1
    vals = vals[:n]
    vals[0] = None
    pdf = pd.DataFrame({"timestamp": ts, "x": vals})
    expect = _pandas_chain(pdf.set_index("timestamp")["x"].astype(float)).tolist()
    rows = [("p", t, v, 1.0) for t, v in zip(ts, vals)]
    df = spark.createDataFrame(rows, "plant_name string, timestamp timestamp_ntz, temperature_2m double, generation_mw double")
    got = [r["temperature_2m"] for r in repair_missing(df, ["temperature_2m"], bucket_hours=24)
           .orderBy("timestamp").collect()]
    assert len(got) == n
    for g, e in zip(got, expect):
        if e is None or (isinstance(e, float) and math.isnan(e)):
            assert g is None
        else:
            assert g == pytest.approx(e, abs=1e-9)


def test_null_plant_rows_are_kept(spark):
    df = _frame(spark, [1, N, 3]).unionByName(
        spark.createDataFrame([(None, hourly(n=1)[0], None)], "plant_name string, timestamp timestamp_ntz, x double"))
    out = interpolate(df, ["x"], limit=6)
    assert out.count() == 4
    assert out.filter(F.col("plant_name").isNull()).count() == 1


def test_fill_by_position_across_row_buckets(spark):
    from wattline.operators.repair import fill_by_position
    rnd = random.Random(19)
    vals = [None if rnd.random() < 0.6 else rnd.uniform(0, 9) for _ in range(500)]
    expect = pd.Series(vals, dtype=float).ffill(limit=5).bfill(limit=3).tolist()
    rows = [("p", t, i + 1, v) for i, (t, v) in enumerate(zip(hourly(n=500), vals))]
    df = spark.createDataFrame(rows, "plant_name string, timestamp timestamp_ntz, _rn long, x double")
    got = [r["x"] for r in fill_by_position(df, ["x"], ffill=5, bfill=3, bucket_rows=30).orderBy("_rn").collect()]
    for g, e in zip(got, expect):
        assert (g is None and math.isnan(e)) or g == pytest.approx(e)

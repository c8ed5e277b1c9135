"""Nearest-in-time as-of join: ties go to the earlier row; bucket carry
equals pandas merge_asof(direction='nearest')."""

import datetime as dt
import random

import pandas as pd
import pytest

from wattline.operators.joins import asof_join, asof_join_carry


def test_fixture_tie_and_exact(spark):
    left = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 30)), (2, dt.datetime(2024, 1, 1, 1, 0))],
                                 "id long, timestamp timestamp_ntz")
    right = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0), 10.0), (dt.datetime(2024, 1, 1, 1, 0), 20.0)],
                                  "timestamp timestamp_ntz, w double")
    got = {r["id"]: r["w"] for r in asof_join(left, right, bucket_seconds=600).collect()}
    assert got == {1: 10.0, 2: 20.0}
    got = {r["id"]: r["w"] for r in asof_join_carry(left, right, bucket_hours=1).collect()}
    assert got == {1: 10.0, 2: 20.0}


@pytest.mark.parametrize("direction", ["nearest", "backward", "forward"])
@pytest.mark.parametrize("impl", ["index-1h", "index-1d", "carry-1h", "carry-1d"])
def test_matches_pandas(spark, direction, impl):
    rnd = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    lt = sorted(t0 + dt.timedelta(seconds=rnd.randint(0, 5 * 86400)) for _ in range(300))
    rt = sorted({t0 + dt.timedelta(seconds=rnd.randint(3600, 4 * 86400)) for _ in range(40)})
    ldf = pd.DataFrame({"id": range(len(lt)), "timestamp": lt})
    rdf = pd.DataFrame({"timestamp": rt, "w": [float(i) for i in range(len(rt))]})
    exp = pd.merge_asof(ldf, rdf, on="timestamp", direction=direction)
    left = spark.createDataFrame(ldf).selectExpr("id", "cast(timestamp as timestamp_ntz) timestamp")
    right = spark.createDataFrame(rdf).selectExpr("cast(timestamp as timestamp_ntz) timestamp", "w")
    kind, size = impl.split("-")
    hours = 1 if size == "1h" else 24
    out = (asof_join(left, right, direction=direction, bucket_seconds=hours * 3600) if kind == "index"
           else asof_join_carry(left, right, direction=direction, bucket_hours=hours))
    got = {r["id"]: r["w"] for r in out.collect()}
    for i, w in zip(exp["id"], exp["w"]):
        assert (got[i] is None and pd.isna(w)) or got[i] == w


def test_by_key(spark):
    left = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 5)), ("b", dt.datetime(2024, 1, 1, 5))],
                                 "site string, timestamp timestamp_ntz")
    right = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 4), 1.0), ("b", dt.datetime(2024, 1, 3, 0), 2.0)],
                                  "site string, timestamp timestamp_ntz, w double")
    got = {r["site"]: r["w"] for r in asof_join(left, right, by=["site"], bucket_seconds=6 * 3600).collect()}
    assert got == {"a": 1.0, "b": 2.0}
    got = {r["site"]: r["w"] for r in asof_join_carry(left, right, by=["site"], bucket_hours=6).collect()}
    assert got == {"a": 1.0, "b": 2.0}


def test_keyless_asof_does_not_window_the_left_side(spark):
    left = spark.range(1000).selectExpr("id", "timestamp_seconds(id * 37) :: timestamp_ntz as timestamp")
    right = spark.range(50).selectExpr("timestamp_seconds(id * 900) :: timestamp_ntz as timestamp", "cast(id as double) as w")
    plan = asof_join(left, right)._jdf.queryExecution().optimizedPlan().toString()
    # the only Window operators are those over the bucket index (carry-in and
    # carry-out inside coarse groups, and over one row per group); left rows
    # are only joined, and the right side is aggregated once
    assert plan.count("Window [") <= 4 and "Range (0, 1000" in plan


def test_null_and_far_times(spark):
    t0 = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, None), (2, dt.datetime(1970, 1, 1)), (3, dt.datetime(9998, 1, 1)), (4, t0)],
                                 "id long, timestamp timestamp_ntz")
    right = spark.createDataFrame([(t0 + dt.timedelta(hours=h), float(h)) for h in range(3000)], "timestamp timestamp_ntz, w double")
    got = {r["id"]: r["w"] for r in asof_join(left, right).collect()}
    assert got == {1: None, 2: 0.0, 3: 2999.0, 4: 0.0}
    back = {r["id"]: r["w"] for r in asof_join(left, right, direction="backward").collect()}
    assert back == {1: None, 2: None, 3: 2999.0, 4: 0.0}
    for direction, first in (("nearest", 0.0), ("backward", None), ("forward", 0.0)):
        got = {r["id"]: r["w"] for r in asof_join_carry(left, right, direction=direction).collect()}
        assert got == {1: None, 2: first, 3: None if direction == "forward" else 2999.0, 4: 0.0}

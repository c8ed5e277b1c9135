"""Halo windows equal plain per-plant windows on the hourly grid."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import hourly
from wattline.operators.features import add_lag_features, add_rolling_features, lookback_sequences


def _grid(spark, n=400, plants=("a", "b", "c")):
    rnd = random.Random(11)
    rows = [(p, t, None if rnd.random() < 0.1 else rnd.uniform(0, 50)) for p in plants for t in hourly(n=n)]
    return spark.createDataFrame(rows, "plant_name string, timestamp timestamp_ntz, y double")


def _rows(df, cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("plant_name", "timestamp").collect()]


def test_lags_and_rolling_equal_plain_window(spark):
    g = _grid(spark)
    lags = (1, 24, 168)
    halo = add_rolling_features(add_lag_features(g, ["y"], lags, bucket_hours=200),
                                {"y": ("mean", "std", "min", "max")}, (3, 24, 168), bucket_hours=200)
    w = Window.partitionBy("plant_name").orderBy("timestamp")
    plain = g.select("*", *[F.lag("y", n).over(w).alias(f"y_lag_{n}h") for n in lags],
                     *[fn("y").over(w.rowsBetween(-(n - 1), 0)).alias(f"y_roll_{s}_{n}h")
                       for n in (3, 24, 168) for s, fn in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))])
    cols = [c for c in plain.columns if c not in ("plant_name", "timestamp")]
    a, b = _rows(halo, cols), _rows(plain, cols)
    assert len(a) == len(b) == 1200
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            assert (x is None and y is None) or x == pytest.approx(y, abs=1e-9)


def test_rolling_std_fixture(spark):
    rows = [("p", t, v) for t, v in zip(hourly(n=4), [1.0, 3.0, None, 7.0])]
    df = spark.createDataFrame(rows, "plant_name string, timestamp timestamp_ntz, y double")
    got = [r["y_roll_std_3h"] for r in add_rolling_features(df, {"y": ("std",)}, (3,)).orderBy("timestamp").collect()]
    assert got[0] is None
    assert got[1:] == [pytest.approx(1.41421356, abs=1e-8), pytest.approx(1.41421356, abs=1e-8), pytest.approx(2.82842712, abs=1e-8)]


def test_lookback_needs_full_window(spark):
    g = _grid(spark, n=60, plants=("a",))
    seq = lookback_sequences(g, ["y"], 24, target="y", bucket_hours=30)
    assert seq.count() == 60 - 24
    first = seq.orderBy("timestamp").first()
    assert len(first["window"]) == 24


def test_halo_rejects_too_small_bucket(spark):
    g = _grid(spark, n=10, plants=("a",))
    with pytest.raises(ValueError):
        add_lag_features(g, ["y"], (48,), bucket_hours=24)


def test_row_index_across_buckets_equals_row_number(spark):
    from wattline.operators.series import row_index
    rnd = random.Random(23)
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [(p, t0 + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 10)), i) for i, p in enumerate(["a", "b"] * 300)]
    df = spark.createDataFrame(rows, "plant_name string, timestamp timestamp_ntz, id long")
    plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("plant_name").orderBy("timestamp", "id")))
    for hours in (1, 7, 720):
        got = {r["id"]: r["rn"] for r in row_index(df, tiebreak=("id",), bucket_hours=hours).collect()}
        assert got == {r["id"]: r["rn"] for r in plain.collect()}


def test_carry_join_back_does_not_reshuffle_the_big_side(spark):
    from wattline.operators.windows import carry_valid
    g = _grid(spark, n=100)
    old = (spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        c = carry_valid(g, ["plant_name"], "timestamp", {"y": "y"}, bucket_hours=48)
        plan = c._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[1])
    assert "SortMergeJoin" in plan
    # the rows are shuffled once, for both the windows and the summary; the
    # summary itself twice (window by key, join side)
    assert plan.count("ReusedExchange") == 1, plan
    assert sum(" Exchange " in line and "Reused" not in line for line in plan.splitlines()) == 3, plan


def test_carry_is_lazy_and_writes_nothing(spark, tmp_path):
    import os
    from wattline.operators.repair import repair_missing
    from wattline.session import checkpoint_dir
    g = _grid(spark, n=50).withColumnRenamed("y", "generation_mw")
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    assert repair_missing(g, []).count() == repair_missing(g.repartition(3), []).count()
    assert (set(os.listdir(folder)) if os.path.isdir(folder) else set()) == before


def test_null_key_rows_pass_the_carry(spark):
    from wattline.operators.windows import carry_valid
    g = _grid(spark, n=30)
    nulls = g.limit(3).withColumn("plant_name", F.lit(None).cast("string"))
    out = carry_valid(g.unionByName(nulls), ["plant_name"], "timestamp", {"y": "y"}, bucket_hours=5)
    assert out.count() == g.count() + 3
    assert out.filter("plant_name is null and (_rn is not null or _prev_y is not null)").count() == 0

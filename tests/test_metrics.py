"""Metric definitions and forecaster invariants."""

import pytest
from pyspark.sql import functions as F

from wattline.operators import evaluation as E
from wattline.operators import forecasting as FC


def _preds(spark, rows):
    return spark.createDataFrame(rows, "model string, y_true double, P10 double, P50 double, P90 double")


def test_point_metrics_with_zero_truth(spark):
    p = _preds(spark, [("m", 0.0, None, 1.0, None), ("m", 2.0, None, 1.0, None), ("m", 4.0, None, 5.0, None)])
    r = E.evaluate_wide(p, probabilistic=False).first()
    assert r["mae"] == pytest.approx(1.0)
    assert r["rmse"] == pytest.approx(1.0)
    assert r["mape"] == pytest.approx((0.5 + 0.25) / 2 * 100)   # zero truth skipped
    assert r["smape"] == pytest.approx((2 + 2 / 3 + 2 / 9) / 3 * 100)
    assert r["cf_mae"] == pytest.approx(0.25)


def test_interval_metrics(spark):
    p = _preds(spark, [("m", 1.0, 0.0, 1.0, 2.0), ("m", 5.0, 0.0, 1.0, 2.0), ("m", 2.0, 1.0, 2.0, 3.0)])
    r = E.evaluate_wide(p).first()
    assert 0.0 <= r["picp_80"] <= 1.0
    assert r["picp_80"] == pytest.approx(2 / 3)
    assert r["mpiw_80"] == pytest.approx(2.0)
    assert r["nmpiw_80"] == pytest.approx(2.0 / 4.0)
    assert r["cwc_80"] == pytest.approx(0.5 * (1 + 10 * (0.8 - 2 / 3) ** 2))
    pb50 = (0 + 0.5 * 4 + 0) / 3
    assert r["pinball_p50"] == pytest.approx(pb50)


def test_long_metrics_and_best(spark):
    p = _preds(spark, [("a", 1.0, 0.0, 1.0, 2.0), ("a", 2.0, 0.0, 1.5, 3.0), ("b", 1.0, None, 3.0, None), ("b", 2.0, None, 3.0, None)])
    long = E.evaluate_model(p)
    assert long.filter((F.col("model") == "b") & (F.col("metric") == "picp_80")).count() == 0
    best = {r["metric"]: r["best_model"] for r in E.best_by_metric(long).collect()}
    assert best["mae"] == "a"


def test_weights_fit_prefers_better_model_and_sums_to_one(spark):
    rows = [(float(i), float(i) + 0.1, float(i) + 5.0) for i in range(50)]
    wide = spark.createDataFrame(rows, "y_true double, good double, bad double")
    w = FC.fit_ensemble_weights(wide, ["good", "bad"], step=0.05).first()
    assert w["w_good"] + w["w_bad"] == pytest.approx(1.0)
    assert w["w_good"] == pytest.approx(1.0)
    assert w["val_mae"] == pytest.approx(0.1)


def test_quantile_bins_are_ordered(spark):
    import random
    rnd = random.Random(5)
    rows = [("p", h % 24, 1, rnd.uniform(0, 10)) for h in range(2000)]
    hist = spark.createDataFrame(rows, "plant_name string, hour int, month int, y_true double")
    bins = FC.fit_quantile_bins(hist)
    assert bins.filter(~((F.col("P10") <= F.col("P50")) & (F.col("P50") <= F.col("P90")))).count() == 0
    assert bins.count() == 24


def test_scaler_roundtrip_and_zero_std(spark):
    from wattline.operators import preprocess as PP
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "a double, c double")
    stats = PP.scaler_fit(df, ["a", "c"])
    s = {r["feature"]: (r["mean"], r["std"]) for r in stats.collect()}
    assert s["a"][0] == pytest.approx(3.0) and s["a"][1] == pytest.approx((14 / 3) ** 0.5)
    assert s["c"][1] == 1.0                      # zero std -> 1
    z = PP.scaler_transform(df, stats, ["a", "c"])
    back = PP.scaler_transform(z, stats, ["a", "c"], inverse=True)
    assert sorted(r["a"] for r in back.collect()) == [pytest.approx(1.0), pytest.approx(2.0), pytest.approx(6.0)]
    assert z.agg(F.avg("a")).first()[0] == pytest.approx(0.0, abs=1e-12)


def test_approx_bins_close_to_exact(spark):
    import random
    rnd = random.Random(9)
    rows = [("p", h % 4, 1, rnd.uniform(0, 10)) for h in range(4000)]
    hist = spark.createDataFrame(rows, "plant_name string, hour int, month int, y_true double")
    exact = {r["hour"]: r for r in FC.fit_quantile_bins(hist).collect()}
    approx = {r["hour"]: r for r in FC.fit_quantile_bins(hist, approx=True).collect()}
    for h in exact:
        for q in ("P10", "P50", "P90"):
            assert abs(exact[h][q] - approx[h][q]) < 0.05

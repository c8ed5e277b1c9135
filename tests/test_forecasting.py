"""Ensemble weights, exact quantiles, conformal ranks, hash split."""

import itertools
import random

import numpy as np
import pytest

from wattline.operators import forecasting as FC
from wattline.operators.quantiles import exact_quantiles
from wattline.operators.series import split_random


def _wide(spark, k, n=80, seed=1):
    rnd = random.Random(seed)
    rows = [(float(rnd.randint(0, 40)), *[float(rnd.randint(0, 40)) for _ in range(k)]) for _ in range(n)]
    names = [f"m{i}" for i in range(k)]
    return spark.createDataFrame(rows, "y_true double, " + ", ".join(f"{m} double" for m in names)), names, np.array(rows)


def _mae(rows, w):
    return float(np.abs(rows[:, 0] - rows[:, 1:] @ np.array(w)).mean())


@pytest.mark.parametrize("k,step", [(2, 0.01), (3, 0.1), (5, 0.25)])
def test_weights_for_any_number_of_models(spark, k, step):
    df, names, rows = _wide(spark, k)
    got = FC.fit_ensemble_weights(df, names, step=step).first()
    w = [got[f"w_{m}"] for m in names]
    n = round(1 / step)
    best = min(_mae(rows, [x / n for x in c]) for c in itertools.product(range(n + 1), repeat=k) if sum(c) == n)
    assert min(w) >= 0 and abs(sum(w) - 1) < 1e-9
    assert abs(got["val_mae"] - _mae(rows, w)) < 1e-9
    assert got["val_mae"] <= best + 1e-9


def test_weights_without_rows(spark):
    df, names, _ = _wide(spark, 2)
    assert FC.fit_ensemble_weights(df.where("false"), names).first()["val_mae"] is None


def test_exact_quantiles_equal_numpy(spark):
    rnd = random.Random(4)
    rows = [("a", rnd.gauss(0, 10)) for _ in range(500)] + [("b", 3.0)] * 40 + [("b", None)] + [("c", 1.0)]
    rows += [("f", 1e12)] + [("f", rnd.random()) for _ in range(400)] + [("f", -1e300), (None, 1.0)]  # values far apart
    rows += [("d", float(rnd.randint(0, 3))) for _ in range(300)] + [("e", 1e9)] + [("e", rnd.random()) for _ in range(99)]
    df = spark.createDataFrame(rows, "k string, v double")
    qs = (0.0, 0.1, 0.5, 0.9, 1.0)
    got = {r["k"]: [r[f"q{i}"] for i in range(5)] for r in exact_quantiles(df, ["k"], "v", qs, [f"q{i}" for i in range(5)]).collect()}
    for k in "abcdef":
        want = np.quantile([v for g, v in rows if g == k and v is not None], qs)
        assert np.allclose(got[k], want)


def test_conformal_ranks(spark):
    val = spark.createDataFrame([("p", float(i), 0.0) for i in range(1, 20)], "plant_name string, y_true double, P50 double")
    test = spark.createDataFrame([("p", 100.0)], "plant_name string, P50 double")
    r = FC.conformal_intervals(val, test).first()
    assert (r["P10"], r["P90"]) == (102.0, 118.0)  # ranks floor(20 * 0.1) and ceil(20 * 0.9) of 19 residuals


def test_ensemble_quantiles_keep_their_order(spark):
    rows = [("p", 1, "a", None, 9.0, None), ("p", 1, "b", 1.0, 2.0, 3.0), ("p", 1, "c", 2.0, 3.0, 4.0)]
    df = spark.createDataFrame(rows, "plant_name string, timestamp int, model string, P10 double, P50 double, P90 double")
    assert FC.ensemble_quantiles(df).first()[2:] == (1.5, 2.5, 3.5)
    weights = spark.createDataFrame([("a", 1.0)], "model string, weight double")
    r = FC.ensemble_predict(df, weights).first()
    assert r["P10"] <= r["P50"] <= r["P90"]
    none = spark.createDataFrame([("z", 1.0)], "model string, weight double")
    assert FC.ensemble_predict(df, none).count() == 1  # no weight at all: the plain mean


def test_hash_split_of_large_ids(spark):
    df = spark.createDataFrame([(4_000_000_000 + i,) for i in range(200)] + [(2**62,), (-5,)], "id long")
    assert split_random(df, "id").count() == 202

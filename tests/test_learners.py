"""Learners for many keys, recursion, draws, ranks: against numpy and sequential loops."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.operators import forecasting as FC
from wattline.operators import learners as L
from wattline.operators.preprocess import label_encode, label_encoder_fit
from wattline.operators.ranks import ranked

KEY = ["plant_name"]


def data(seed=0, sizes=(("a", 80), ("b", 25), ("c", 1))):
    r = np.random.default_rng(seed)
    rows = []
    for p, n in sizes:
        for i in range(n):
            x = r.standard_normal(2) * [1, 30]
            y = float(3 + x @ [2, -0.5] + r.gamma(1, 2))
            rows.append((p, i, float(x[0]), float(x[1]), float(4 * x[0] - x[1]), 7.0, y))
    rows += [("a", 900, None, 1.0, 1.0, 7.0, 1.0), ("b", 901, 1.0, 1.0, 3.0, 7.0, None), (None, 902, 1.0, 1.0, 3.0, 7.0, 2.0)]
    return rows


SCHEMA = "plant_name string, i long, x0 double, x1 double, x2 double, x3 double, y double"


def test_least_squares_of_every_key(spark):
    rows = data()
    df = spark.createDataFrame(rows, SCHEMA)
    feats = ["x0", "x1", "x2", "x3"]  # x2 is determined by the first two, x3 is constant
    model = L.fit_linear(df, KEY, "y", feats)
    weights = {r["plant_name"]: r for r in model.collect()}
    assert weights["a"]["n"] == 80 and weights["a"]["weights"][2:] == [0.0, 0.0]
    got = L.predict_linear(df, model, KEY, feats).collect()
    for p in "abc":
        own = [r for r in rows if r[0] == p and None not in r]
        a = np.array([[*r[2:6], 1.0] for r in own])
        want = a @ np.linalg.lstsq(a, np.array([r[6] for r in own]), rcond=None)[0]
        mine = {r["i"]: r["P50"] for r in got if r["plant_name"] == p}
        assert np.allclose([mine[r[1]] for r in own], want, atol=1e-8)
        assert all(mine[r[1]] is None for r in rows if r[0] == p and None in r[2:6])
    long = L.weights_long(model, KEY, feats).where("plant_name = 'b'").collect()
    assert [r["feature"] for r in long] == ["intercept", *feats] and long[1]["weight"] == weights["b"]["weights"][0]


def pinball(r, q):
    return np.maximum(q * r, (q - 1) * r).mean()


def test_quantile_models_are_optimal(spark):
    """The least loss of a line with one feature is reached by one through two points."""
    r = np.random.default_rng(5)
    rows = [(p, float(x), float(2 * x + r.gamma(1, 3) * (1 + abs(x)))) for p, n in (("a", 40), ("b", 15)) for x in r.standard_normal(n)]
    df = spark.createDataFrame(rows + [("a", None, 1.0)], "plant_name string, x double, y double")
    model = L.fit_quantiles(df, KEY, "y", ["x"], tol=5e-3)
    for m in model.collect():
        own = np.array([[x, y] for p, x, y in rows if p == m["plant_name"]])
        for q, (b0, b1), gap in zip((0.1, 0.5, 0.9), m["coefs"], m["gap"]):
            best = min(pinball(own[:, 1] - (own[i, 1] + s * (own[:, 0] - own[i, 0])), q)
                       for i, j in itertools.combinations(range(len(own)), 2)
                       for s in [(own[i, 1] - own[j, 1]) / (own[i, 0] - own[j, 0])])
            loss = pinball(own[:, 1] - b0 - b1 * own[:, 0], q)
            assert best - 1e-9 <= loss <= best * 1.02 and gap <= 5e-3
    out = L.predict_quantiles(df, model, KEY, ["x"]).where("x is not null").collect()
    assert all(o["P10"] <= o["P50"] <= o["P90"] for o in out) and len(out) == len(rows)


def test_quantiles_of_constant_series(spark):
    df = spark.createDataFrame([("a", float(i), 4.0) for i in range(9)] + [("b", 1.0, 2.0)], "plant_name string, x double, y double")
    for m in L.fit_quantiles(df, KEY, "y", ["x"]).collect():
        want = 4.0 if m["plant_name"] == "a" else 2.0
        assert all(abs(b + w - want) < 1e-6 for b, w in m["coefs"])


@pytest.mark.parametrize("bucket", [30, 1 << 16])
def test_recursion_equals_a_loop(spark, bucket):
    rnd = random.Random(2)
    series = {p: [rnd.gauss(10, 3) for _ in range(n)] for p, n in (("a", 90), ("b", 12), ("c", 3))}
    rows = [(p, i + 1, v) for p, vs in series.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "plant_name string, rn long, y double")
    lags, steps = (1, 2, 6), 5
    d = L.lag_columns(L.lag_frame(df, KEY, "rn", "y", 6, ahead=steps, bucket_rows=bucket), lags)
    for r in d.collect():
        vs = series[r["plant_name"]]
        assert r["before"] == vs[max(0, r["rn"] - 7):r["rn"] - 1] and r["ahead"] == vs[r["rn"]:r["rn"] + steps]
        assert [r[f"lag_{n}"] for n in lags] == [vs[r["rn"] - 1 - n] if r["rn"] > n else None for n in lags]
    model = spark.createDataFrame([("a", 1.0, [0.5, 0.2, 0.1]), ("c", 0.0, [1.0, 1.0, 1.0])], "plant_name string, intercept double, weights array<double>")
    got = L.by_step(L.forecast_recursive(d.withColumn("state", F.concat("before", F.array("y"))), model, KEY, lags, "state", steps), ["plant_name", "rn"]).collect()
    want = {}
    vs = series["a"]
    for rn in range(6, 91):
        acc = vs[:rn]
        for s in range(1, steps + 1):
            acc = [*acc, 1.0 + 0.5 * acc[-1] + 0.2 * acc[-2] + 0.1 * acc[-6]]
            want["a", rn, s] = (acc[-1], vs[rn + s - 1] if rn + s <= 90 else None)
    assert {(r["plant_name"], r["rn"], r["step"]) for r in got} == set(want)
    for r in got:
        f, y = want[r["plant_name"], r["rn"], r["step"]]
        assert abs(r["P50"] - f) < 1e-9 and r["y_true"] == y
    errors = L.error_by_step(spark.createDataFrame(got)).where("step = 2").first()
    e = [y - f for (_, _, s), (f, y) in want.items() if s == 2 and y is not None]
    assert errors["n"] == len(e) and abs(errors["mae"] - np.abs(e).mean()) < 1e-9 and abs(errors["bias"] - np.mean(e)) < 1e-9


@pytest.mark.parametrize("k,step,seed", [(3, 0.01, 0), (3, 0.02, 1), (3, 0.05, 2), (4, 0.05, 3), (4, 0.02, 4), (1, 0.1, 5)])
def test_weights_are_the_grids_optimum(spark, k, step, seed):
    r = np.random.default_rng(seed)
    a = np.column_stack([r.normal(20, 5, 40), *(r.normal(20, 5, 40) for _ in range(k))]) if seed % 2 else r.integers(0, 30, (40, k + 1)).astype(float)
    names = [f"m{i}" for i in range(k)]
    df = spark.createDataFrame([tuple(map(float, x)) for x in a] + [(None, *[1.0] * k)], "y_true double, " + ", ".join(f"{m} double" for m in names))
    got = FC.fit_ensemble_weights(df, names, step=step).first()
    n = round(1 / step)
    grid = [c for c in itertools.product(range(n + 1), repeat=k - 1) if sum(c) <= n]
    grid = np.array(grid, float).reshape(len(grid), k - 1)
    grid = np.column_stack([grid, n - grid.sum(axis=1)]) / n
    mae = np.abs(a[:, :1] - a[:, 1:] @ grid.T).mean(axis=0)
    w = np.array([got[f"w_{m}"] for m in names])
    assert abs(w.sum() - 1) < 1e-9 and abs(got["val_mae"] - mae.min()) < 1e-9
    assert abs(np.abs(a[:, 0] - a[:, 1:] @ w).mean() - mae.min()) < 1e-9


def test_draws(spark):
    rnd = random.Random(3)
    val = spark.createDataFrame([("a", i, rnd.gauss(0, 4), 0.0) for i in range(400)] + [("b", 1, 5.0, 2.0), ("b", 2, None, 2.0)],
                                "plant_name string, timestamp int, y_true double, P50 double")
    res = FC.residual_table(val)
    assert [r["residual"] for r in res.where("plant_name = 'a'").orderBy("rank").collect()] == sorted(r["y_true"] for r in val.where("plant_name = 'a'").collect())
    points = spark.createDataFrame([(p, t, 100.0 * t) for p in ("a", "b", "c") for t in range(60)], "plant_name string, timestamp int, P50 double")
    one = FC.forecast_draws(points, res, draws=50)
    two = FC.forecast_draws(points.repartition(7, "timestamp"), res.repartition(5), draws=50)
    key = lambda r: (r["plant_name"], r["timestamp"], r["draw"])
    one = sorted(one.collect(), key=key)
    assert one == sorted(two.collect(), key=key) and len(one) == 3 * 60 * 50
    shifts = [r["value"] - r["P50"] for r in one if r["plant_name"] == "a"]
    have = [r["y_true"] for r in val.where("plant_name = 'a'").collect()]
    assert np.abs(np.quantile(shifts, [0.1, 0.5, 0.9]) - np.quantile(have, [0.1, 0.5, 0.9])).max() < 0.6
    assert {r["value"] - r["P50"] for r in one if r["plant_name"] == "b"} == {3.0} and all(r["value"] is None for r in one if r["plant_name"] == "c")


def test_ranks_and_encoder_without_a_single_task(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice("abc") if i % 9 else None, rnd.randint(0, 50), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, v int, i int").repartition(6)
    for keys in ([], ["k"]):
        got = ranked(df, ["v", "i"], keys).collect()
        for k in ({None, "a", "b", "c"} if keys else {0}):
            own = sorted((r["rank"], r["v"], r["i"]) for r in got if not keys or r["k"] == k)
            assert [o[0] for o in own] == list(range(len(own))) and [o[1:] for o in own] == sorted(o[1:] for o in own)
        assert len(got) == 900
    words = [(f"w{rnd.randint(0, 300)}",) for _ in range(2000)] + [(None,)]
    df = spark.createDataFrame(words, "c string")
    enc = label_encoder_fit(df, "c")
    assert "SinglePartition" not in enc._jdf.queryExecution().toString()
    order = sorted({w for (w,) in words if w})
    assert {r["value"]: r["label"] for r in enc.collect()} == {w: i for i, w in enumerate(order)}
    out = label_encode(spark.createDataFrame([("w1",), ("zz",), (None,)], "c string"), enc, "c").collect()
    assert sorted(r["c_encoded"] for r in out) == sorted([order.index("w1"), -1, -1])
    assert label_encoder_fit(df.where("false"), "c").count() == 0
    with pytest.raises(ValueError):
        ranked(df, ["c"], out="c")

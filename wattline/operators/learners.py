"""Learners for many series in one job, fitted from grouped sums.

A model for each plant needs no loop over plants: one grouped aggregate gives
every plant's means and co-moments (partial sums, so a plant may hold any
share of the rows), and elimination inside array expressions turns them into
weights.  Fitted state is a table with one row for each key.

* :func:`fit_linear` / :func:`predict_linear`: least squares.
* :func:`fit_quantiles` / :func:`predict_quantiles`: pinball loss.  Each pass
  is one such aggregate; a bound on the loss still to gain says when to stop.
* :func:`lag_frame` / :func:`forecast_recursive`: a model over lags rolled
  forward, each step's forecast being the next step's lag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.operators.windows import halo_window
from wattline.session import materialize

TINY = 1e-9      # a pivot below this share of its variance marks a feature that the others determine
RELAX = 1.5      # step length of a pass, below 2 so that the loss never grows
SHARPEN = 0.5    # how fast the smoothing shrinks


def solve(matrix: Column, size: int) -> Column:
    """Solution of a symmetric positive semidefinite system with unit diagonal,
    given as rows of length ``size + 1`` (right side last), by Gauss-Jordan
    elimination in order.  An entry whose pivot vanishes (a feature that the
    ones before it determine) is 0."""
    def eliminate(m, p):
        row = F.element_at(m, p)
        pivot = F.element_at(row, p)
        scaled = F.transform(row, lambda v: F.when(pivot > TINY, v / pivot).otherwise(0.0))

        def step(other, i):
            factor = F.element_at(other, p)
            return F.when(i + 1 == p, scaled).otherwise(F.zip_with(other, scaled, lambda a, b: a - factor * b))
        return F.transform(m, step)

    done = F.aggregate(F.sequence(F.lit(1), F.lit(size)), matrix, eliminate)
    return F.transform(done, lambda row: F.element_at(row, -1))


def _dot(weights: Column, values: Sequence[Column]) -> Column:
    out = F.lit(0.0)
    for i, v in enumerate(values):
        out = out + F.get(weights, F.lit(i)) * v
    return out


def _known(cols: Sequence[str]) -> Column:
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull()
    return ok


def fit_linear(df: DataFrame, keys: Sequence[str], y: str, features: Sequence[str]) -> DataFrame:
    """Least squares of ``y`` on ``features`` for each key: ``keys``, ``n``,
    ``intercept``, ``weights`` (array, in the features' order).

    Rows with a null in any of them take no part; a key without such rows has
    no model.  Features that are constant or that earlier ones determine get
    weight 0."""
    f, k = list(features), len(features)
    data = df.filter(_known([y, *f])).select(*keys, F.col(y).cast("double").alias("_y"),
                                             *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(f)])
    aggs = [F.count(F.lit(1)).alias("n"), F.avg("_y").alias("_my")]
    for i in range(k):
        aggs += [F.avg(f"_x{i}").alias(f"_m{i}"), F.covar_pop(f"_x{i}", "_y").alias(f"_b{i}")]
        aggs += [F.covar_pop(f"_x{i}", f"_x{j}").alias(f"_c{i}_{j}") for j in range(i, k)]
    sums = data.groupBy(*keys).agg(*aggs)
    scale = [F.sqrt(F.col(f"_c{i}_{i}")) for i in range(k)]

    def unit(value: str, *by: int) -> Column:
        den = F.lit(1.0)
        for i in by:
            den = den * scale[i]
        return F.coalesce(F.try_divide(F.col(value), F.when(den > 0, den)), F.lit(0.0))

    rows = F.array(*[F.array(*[unit(f"_c{min(i, j)}_{max(i, j)}", i, j) for j in range(k)], unit(f"_b{i}", i)) for i in range(k)])
    sums = sums.withColumn("_w", solve(rows, k))
    weights = F.array(*[F.coalesce(F.try_divide(F.get(F.col("_w"), F.lit(i)), F.when(scale[i] > 0, scale[i])), F.lit(0.0)) for i in range(k)])
    sums = sums.withColumn("weights", weights)
    return sums.select(*keys, "n", (F.col("_my") - _dot(F.col("weights"), [F.col(f"_m{i}") for i in range(k)])).alias("intercept"), "weights")


def predict_linear(df: DataFrame, model: DataFrame, keys: Sequence[str], features: Sequence[str], out: str = "P50") -> DataFrame:
    """``df`` with the forecast of its key's model (NULL without a model or with a null feature)."""
    m = model.select(*keys, F.col("intercept").alias("_intercept"), F.col("weights").alias("_weights"))
    j = df.join(m, list(keys), "left")
    return j.withColumn(out, F.col("_intercept") + _dot(F.col("_weights"), [F.col(c).cast("double") for c in features])).drop("_intercept", "_weights")


def weights_long(model: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """One row for each key and feature, the intercept included."""
    names = F.array(F.lit("intercept"), *[F.lit(f) for f in features])
    pairs = F.arrays_zip(names.alias("feature"), F.concat(F.array("intercept"), F.col("weights")).alias("weight"))
    return model.select(*keys, "n", F.explode(pairs).alias("_p")).select(*keys, "n", "_p.feature", "_p.weight")


# --- pinball loss ------------------------------------------------------------------

def fit_quantiles(df: DataFrame, keys: Sequence[str], y: str, features: Sequence[str],
                  qs: Sequence[float] = (0.1, 0.5, 0.9), tol: float = 1e-3) -> DataFrame:
    """Linear quantile models by pinball loss for each key: ``keys``, ``n``,
    ``coefs`` (for each quantile intercept and weights), ``gap`` (for each
    quantile the share of the loss that might still be gained at most) and
    ``passes``.

    The loss is smoothed by a width h and its quadratic bound at the current
    weights is minimised: sums over the rows, then one elimination for each
    key and quantile.  The loss never grows from pass to pass, and h shrinks
    as the passes settle.  The slopes of the smoothed loss are a point of the
    dual problem, so ``loss - sum(slope * residual)`` bounds what is left to
    gain, up to the gradient; a key is done when bound and gradient are below
    ``tol``.  There is no limit on the passes.  Rows with a null take no part."""
    f, k = list(features), len(features)
    start = fit_linear(df, keys, y, f)
    rows = df.filter(_known([y, *f])).select(*keys, F.col(y).cast("double").alias("_y"),
                                             *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(f)])
    rows = materialize(rows)
    xs = [F.lit(1.0), *[F.col(f"_x{i}") for i in range(k)]]
    spread = predict_linear(rows, start, keys, [f"_x{i}" for i in range(k)], "_p").groupBy(*keys).agg(
        F.avg(F.abs(F.col("_y") - F.col("_p"))).alias("_h"))
    first = F.concat(F.array("intercept"), F.col("weights"))
    model = materialize(start.join(spread, list(keys)).select(
        *keys, "n", F.array(*[first] * len(qs)).alias("coefs"), F.array(*[F.greatest("_h", F.lit(1e-12))] * len(qs)).alias("_hs"),
        F.array(*[F.lit(1.0)] * len(qs)).alias("gap"), F.array(*[F.lit(False)] * len(qs)).alias("_done"), F.lit(0).alias("passes")))
    # the columns of a pass are named, so they are built once
    sizes = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    ratio = lambda a, b: F.coalesce(F.try_divide(a, F.when(b > 0, b)), F.lit(0.0))
    residuals = [(F.col("_y") - _dot(F.col("coefs")[t], xs)).alias(f"_r{t}") for t in range(len(qs))]
    tanhs = [F.tanh(F.col(f"_r{t}") / (2.0 * F.col("_hs")[t])).alias(f"_t{t}") for t in range(len(qs))]
    aggs = [F.avg(F.abs(x)).alias(f"_u{i}") for i, x in enumerate(xs)]
    bends, solved, judged, moved = [], [], [], []
    for t, q in enumerate(qs):
        r, d, h = F.col(f"_r{t}"), F.lit(q - 0.5) + F.col(f"_t{t}") / 2.0, F.col("_hs")[t]
        bends.append(F.when(F.abs(r) < 1e-6 * h, 0.25 / h).otherwise(F.col(f"_t{t}") / (2.0 * r)).alias(f"_a{t}"))
        aggs += [F.avg(F.greatest(q * r, (q - 1.0) * r)).alias(f"_loss{t}"), F.avg(d * r).alias(f"_dual{t}")]
        aggs += [F.avg(d * x).alias(f"_g{t}_{i}") for i, x in enumerate(xs)]
        aggs += [F.avg(F.col(f"_a{t}") * xs[i] * xs[l]).alias(f"_h{t}_{i}_{l}") for i, l in sizes]
        scale = [F.sqrt(F.col(f"_h{t}_{i}_{i}")) for i in range(k + 1)]
        matrix = F.array(*[F.array(*[ratio(F.col(f"_h{t}_{min(i, l)}_{max(i, l)}"), scale[i] * scale[l]) for l in range(k + 1)],
                                   ratio(F.col(f"_g{t}_{i}"), scale[i])) for i in range(k + 1)])
        solved.append(F.zip_with(solve(matrix, k + 1), F.array(*scale), lambda v, c: ratio(v, c)).alias(f"_s{t}"))
        slope = sum((ratio(F.abs(F.col(f"_g{t}_{i}")), F.col(f"_u{i}")) for i in range(k + 1)), F.lit(0.0)) / min(q, 1 - q)
        left = ratio(F.greatest(F.col(f"_loss{t}") - F.col(f"_dual{t}"), F.lit(0.0)), F.col(f"_loss{t}"))
        judged.append(F.struct(left.alias("gap"), slope.alias("slope"), (F.col(f"_loss{t}") <= 1e-12 * F.col("_hs")[t]).alias("nothing")).alias(f"_j{t}"))
        now = F.col(f"_j{t}")
        ok = F.col("_done")[t] | ((now["gap"] <= tol) & (now["slope"] <= 3 * tol)) | now["nothing"]
        moved.append((F.when(ok, F.col("coefs")[t]).otherwise(F.zip_with(F.col("coefs")[t], F.col(f"_s{t}"), lambda c, v: c + RELAX * v)),
                      F.when((now["gap"] > tol) & (now["slope"] < 0.3), F.col("_hs")[t] * SHARPEN).otherwise(F.col("_hs")[t]),
                      F.when(F.col("_done")[t], F.col("gap")[t]).otherwise(now["gap"]), ok))
    fresh = [F.array(*[m[c] for m in moved]).alias(name) for c, name in enumerate(("coefs", "_hs", "gap", "_done"))]
    state, unfinished = [*keys, "n", "coefs", "_hs", "gap", "_done", "passes"], F.exists("_done", lambda d: ~d)
    while model.filter(unfinished).limit(1).count():
        open_ = model.filter(unfinished)
        each = rows.join(open_.select(*keys, "coefs", "_hs"), list(keys)).select("*", *residuals).select("*", *tanhs).select("*", *bends)
        sums = open_.join(each.groupBy(*keys).agg(*aggs), list(keys)).select(*state, *judged, *solved)
        model = materialize(sums.select(*keys, "n", *fresh, (F.col("passes") + 1).alias("passes")).select(*state)
                            .unionByName(model.filter(~unfinished)))
    return model.select(*keys, "n", "coefs", "gap", "passes")


def predict_quantiles(df: DataFrame, model: DataFrame, keys: Sequence[str], features: Sequence[str],
                      names: Sequence[str] = ("P10", "P50", "P90")) -> DataFrame:
    """``df`` with its key's quantiles in ascending order.  Fitted lines may
    cross; sorting a row's values never raises the summed pinball loss."""
    j = df.join(model.select(*keys, F.col("coefs").alias("_coefs")), list(keys), "left")
    xs = [F.lit(1.0), *[F.col(c).cast("double") for c in features]]
    j = j.withColumn("_qs", F.array_sort(F.array(*[_dot(F.col("_coefs")[t], xs) for t in range(len(names))])))
    return j.select(*df.columns, *[F.col("_qs")[t].alias(c) for t, c in enumerate(names)])


# --- recursion over lags --------------------------------------------------------------

def lag_frame(df: DataFrame, keys: Sequence[str], rn: str, y: str, reach: int, ahead: int = 0, bucket_rows: int = 1 << 16) -> DataFrame:
    """``df`` with ``before`` (the ``reach`` values before the row, oldest
    first; fewer at the start of a series) and ``ahead`` (the next ``ahead``
    values).  One halo window over blocks of the row number ``rn``."""
    def build(w):
        out = [F.collect_list(y).over(w.rowsBetween(-reach, -1)).alias("before")]
        return out + ([F.collect_list(y).over(w.rowsBetween(1, ahead)).alias("ahead")] if ahead else [])
    return halo_window(df, keys, rn, build, back=reach, fwd=ahead, bucket_hours=max(reach, ahead, bucket_rows), index_col=rn, order=[rn])


def lag_columns(df: DataFrame, lags: Sequence[int], source: str = "before") -> DataFrame:
    """``lag_<n>`` columns read from the array of previous values (NULL where it is too short)."""
    return df.withColumns({f"lag_{n}": F.get(F.col(source), F.size(source) - n) for n in lags})


def forecast_recursive(origins: DataFrame, model: DataFrame, keys: Sequence[str], lags: Sequence[int], state: str,
                       horizon: int = 24, out: str = "forecast") -> DataFrame:
    """``origins`` with ``out``: ``horizon`` forecasts from each row's
    ``state`` (array of its last values, oldest first, as long as the longest
    lag).  A fold over the steps: each forecast is appended and read as a lag
    by the later steps.  Rows with a shorter state or without a model get
    NULL."""
    m = model.select(*keys, F.col("intercept").alias("_intercept"), F.col("weights").alias("_weights"))
    j = origins.join(m, list(keys), "left")

    def step(acc, _):
        value = F.col("_intercept")
        for i, n in enumerate(lags):
            value = value + F.get(F.col("_weights"), F.lit(i)) * F.get(acc, F.size(acc) - n)
        return F.concat(acc, F.array(value))

    rolled = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col(state), step)
    whole = (F.size(state) >= max(lags)) & F.col("_weights").isNotNull()
    return j.withColumn(out, F.when(whole, F.slice(rolled, F.size(state) + 1, F.lit(horizon)))).drop("_intercept", "_weights")


def by_step(df: DataFrame, keep: Sequence[str], forecast: str = "forecast", actual: str = "ahead") -> DataFrame:
    """One row for each origin and step: ``step`` (from 1), ``P50``, ``y_true`` (NULL beyond the series)."""
    zipped = F.transform(F.col(forecast), lambda v, i: F.struct((i + 1).alias("step"), v.alias("P50"), F.get(F.col(actual), i).alias("y_true")))
    return df.select(*keep, F.explode(zipped).alias("_s")).select(*keep, "_s.step", "_s.P50", "_s.y_true")


def error_by_step(steps: DataFrame, group: Sequence[str] = ("step",)) -> DataFrame:
    """Count, MAE, RMSE and mean error of the forecasts of each step (rows with a value to compare)."""
    e = F.col("y_true") - F.col("P50")
    return steps.filter(e.isNotNull()).groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"),
                                                          F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"))

"""Forecasters and ensembles expressed as Spark aggregations and joins.

* quantile bins: P10/P50/P90 of history per (plant, month, hour), joined to
  the rows to forecast (exact ranks without a buffer per group;
  ``approx=True`` switches to ``percentile_approx``).
* ensemble weights: branch and bound on the simplex grid, each pass one
  aggregate over the open boxes' points.
* draws: residuals of a forecaster looked up at hashed ranks.
* gradient-boosted trees (Spark ML) + split-conformal intervals.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline import config as C
from wattline.functions import forecast as FF
from wattline.functions.stats import pearson
from wattline.operators.evaluation import clip_interval
from wattline.operators.quantiles import exact_quantiles, values_at
from wattline.operators.ranks import ranked
from wattline.session import materialize


def quantile_labels(qs: Sequence[float]) -> list[str]:
    return [f"P{int(round(q * 100))}" for q in qs]


def fit_quantile_bins(history: DataFrame, keys: Sequence[str] = ("plant_name", "month", "hour"),
                      y: str = "y_true", qs: Sequence[float] = C.QUANTILES, approx: bool = False) -> DataFrame:
    """Per-bin quantiles of ``y`` (one row per bin); ``approx`` takes
    ``percentile_approx`` instead of the exact ranks."""
    if approx:
        arr = F.array(*[F.lit(float(q)) for q in qs])
        g = history.filter(F.col(y).isNotNull()).groupBy(*keys).agg(F.percentile_approx(y, arr, 10000).alias("_q"))
        return g.select(*keys, *[F.col("_q")[i].alias(lab) for i, lab in enumerate(quantile_labels(qs))])
    return exact_quantiles(history, keys, y, qs, quantile_labels(qs))


def predict_quantile_bins(rows: DataFrame, model: DataFrame, keys: Sequence[str] = ("plant_name", "month", "hour")) -> DataFrame:
    """Left join: unseen bins get NULL quantiles (use ``interval_fallback``)."""
    return rows.join(model, on=list(keys), how="left")


def add_month_hour(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumns({"month": F.month(ts).cast("int"), "hour": F.hour(ts).cast("int")})


# --- ensemble ----------------------------------------------------------------

def fit_ensemble_weights(wide: DataFrame, models: Sequence[str], y: str = "y_true", step: float = 0.01) -> DataFrame:
    """The weights >= 0 on the ``step`` grid summing to 1 with the least MAE of
    sum(w_i * pred_i), for any number of models; of equal MAE the one with
    the least weight of the first model, then of the second, and so on.

    Branch and bound over boxes of the weight simplex, the last weight being
    the rest.  A pass evaluates one grid point of every open box: MAE and
    slope, one aggregate row for each, from rows that are written once.  The
    MAE is convex, so the tangents of a box and of its ancestors bound it from
    below; boxes whose bound exceeds the best point are dropped, the others
    are halved in every direction.  It ends when no box is left, which is at
    the grid's optimum."""
    n, k = round(1 / step), len(models)
    ok = F.col(y).isNotNull()
    for m in models:
        ok = ok & F.col(m).isNotNull()
    rows = materialize(wide.filter(ok).select(F.col(y).cast("double").alias("_y"), F.array(*[F.col(m).cast("double") for m in models]).alias("_p")))

    def evaluate(points: list[tuple[int, ...]]) -> list[tuple[float, list[float]]]:
        """MAE and its slope by each weight, at every point."""
        shares = F.array(*[F.array(*[F.lit(x / n) for x in w]) for w in points])
        each = rows.select("_y", "_p", F.posexplode(shares).alias("_i", "_w"))
        error = F.col("_y") - F.aggregate(F.zip_with("_w", "_p", lambda w, p: w * p), F.lit(0.0), lambda a, v: a + v)
        each = each.select("_i", "_p", error.alias("_e"))
        sums = each.groupBy("_i").agg(F.avg(F.abs("_e")).alias("_f"), *[F.avg(-F.signum("_e") * F.col("_p")[m]).alias(f"_g{m}") for m in range(k)])
        got = {r["_i"]: (r["_f"], [r[f"_g{m}"] for m in range(k)]) for r in sums.collect()}  # one row for each point asked
        return [got[i] for i in range(len(points))] if got else []

    def inside(low, high):
        """A grid point of the box, near its middle."""
        out, room = list(low), n - sum(low)
        for i in range(k - 1):
            out[i] += min((high[i] - low[i]) // 2, room)
            room = n - sum(out)
        return (*out, n - sum(out))

    def least(cut, low, high) -> float:
        """Least value of a tangent over a box: weights go to the models with the steepest descent."""
        at, value, slope = cut
        total = value + sum(s * (a - b) / n for s, a, b in zip(slope, (*low, n - sum(low)), at, strict=True))
        room = n - sum(low)
        for s, i in sorted((slope[i] - slope[-1], i) for i in range(k - 1)):
            if s >= 0 or not room:
                break
            moved = min(high[i] - low[i], room)
            total += s * moved / n
            room -= moved
        return total

    seen: dict[tuple[int, ...], float] = {}
    open_ = [((0,) * (k - 1), (n,) * (k - 1), [])]  # corners and the tangents that reach the box
    while open_:
        points = [inside(low, high) for low, high, _ in open_]
        found = evaluate(points)
        if not found:  # no row holds all predictions
            break
        seen |= {w: f for (f, _), w in zip(found, points, strict=True)}
        cuts = [(w, f, g) for (f, g), w in zip(found, points, strict=True)]
        top = min(seen.values())
        slack = top + 1e-9 * top + 1e-12  # keeps ties
        children = []
        for (low, high, old), cut in zip(open_, cuts, strict=True):
            if low == high:
                continue
            tangents = [*old[-5:], cut]
            halves = [[(a, b)] if a == b else [(a, (a + b) // 2), ((a + b) // 2 + 1, b)] for a, b in zip(low, high, strict=True)]
            for part in itertools.product(*halves):
                lo, hi = tuple(a for a, _ in part), tuple(b for _, b in part)
                if sum(lo) <= n and max(least(t, lo, hi) for t in tangents) <= slack:
                    children.append((lo, hi, tangents))
        open_ = children
    top = min(seen.values(), default=None)
    equal = [w for w, f in seen.items() if f <= top + 1e-12 * top] or [tuple(n // k + (i < n % k) for i in range(k))]
    schema = ", ".join(f"`w_{m}` double" for m in models) + ", val_mae double"
    return wide.sparkSession.createDataFrame([(*[x / n for x in min(equal)], top)], schema)


def ensemble_weighted(wide: DataFrame, weights: dict[str, float | Column], out: str = "P50") -> DataFrame:
    """sum(w_i * pred_i) / sum(w_i) over models with a prediction."""
    num = sum((F.coalesce(F.col(m) * w, F.lit(0.0)) for m, w in _wcols(weights)), F.lit(0.0))
    den = sum((F.when(F.col(m).isNotNull(), w).otherwise(F.lit(0.0)) for m, w in _wcols(weights)), F.lit(0.0))
    return wide.withColumn(out, F.try_divide(num, den))


def _wcols(weights):
    return [(m, w if isinstance(w, Column) else F.lit(float(w))) for m, w in weights.items()]


def ensemble_quantiles(long_preds: DataFrame, keys: Sequence[str] = ("plant_name", "timestamp"),
                       method: str = "mean", qcols: Sequence[str] = ("P10", "P50", "P90")) -> DataFrame:
    """Combine each quantile across the models that have all of them
    (``mean`` or ``median``); point forecasts take no part, so the quantiles
    of a row keep their order."""
    whole = F.lit(True)
    for c in qcols:
        whole = whole & F.col(c).isNotNull()
    fn = (lambda c: F.avg(c)) if method == "mean" else (lambda c: F.percentile(c, 0.5))  # a few models per key
    return long_preds.filter(whole).groupBy(*keys).agg(*[fn(c).alias(c) for c in qcols])


def ensemble_predict(long_preds: DataFrame, weights: DataFrame, keys: Sequence[str] = ("plant_name", "timestamp"),
                     factors=C.INTERVAL_FALLBACK) -> DataFrame:
    """P50 = weighted mean of model P50 (weights table: model, weight); a
    model without a weight counts 0, and rows where no model has a weight
    take the plain mean.  P10/P90 = mean across models that have them, else
    P50*lo / P50*hi; the three are put in order."""
    j = long_preds.join(weights, on="model", how="left").filter(F.col("P50").isNotNull())
    g = j.groupBy(*keys).agg(
        F.coalesce(F.try_divide(F.sum(F.col("weight") * F.col("P50")), F.sum("weight")), F.avg("P50")).alias("P50"),
        F.avg("P10").alias("P10"), F.avg("P90").alias("P90"))
    lo, hi = FF.interval_fallback("P50", "P10", "P90", factors)
    return clip_interval(g.select(*keys, lo.alias("P10"), "P50", hi.alias("P90")))


def residual_table(calibration: DataFrame, keys: Sequence[str] = ("plant_name",), y: str = "y_true", point: str = "P50",
                   tiebreak: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Residuals of a forecaster with their rank in their key: ``keys``,
    ``rank`` (from 0), ``size`` and ``residual``."""
    res = calibration.select(*keys, (F.col(y) - F.col(point)).alias("residual"), *tiebreak).filter(F.col("residual").isNotNull())
    placed = ranked(res, ["residual", *tiebreak], keys)
    sizes = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    return placed.join(sizes, list(keys)).select(*keys, "rank", "size", "residual")


def hash_uniform(cols: Sequence[str], seed: int = 42):
    """A number in [0, 1) for each row and draw, from a hash of ``cols``."""
    return lambda draw: F.pmod(F.xxhash64(*cols, draw, F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))


def forecast_draws(points: DataFrame, residuals: DataFrame, keys: Sequence[str] = ("plant_name",), draws: int = 50,
                   point: str = "P50", uniform=None) -> DataFrame:
    """``points`` with ``draw`` (0 ..) and ``value``: forecast plus a residual
    of its key, drawn by inverse CDF.  ``uniform(draw)`` gives the number in
    [0, 1) that picks the rank (default: a hash of all columns), so draws do
    not depend on partitions or on the order of rows.  Rows whose key has no
    residuals draw NULL."""
    uniform = uniform or hash_uniform(points.columns)
    sizes = residuals.filter(F.col("rank") == 0).select(*keys, F.col("size").alias("_size"))
    each = points.join(sizes, list(keys), "left").withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    each = each.withColumn("rank", F.floor(uniform(F.col("draw")) * F.col("_size")).cast("long"))
    j = each.join(residuals.select(*keys, "rank", "residual"), [*keys, "rank"], "left")
    return j.select(*points.columns, "draw", (F.col(point) + F.col("residual")).alias("value"))


def sample_quantiles(draws: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float] = C.QUANTILES) -> DataFrame:
    """Mean, population std and quantiles over repeated draws per key."""
    g = draws.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
                                 F.percentile(value, F.array(*[F.lit(q) for q in qs])).alias("_q"))
    return g.select(*keys, "mean", "std", *[F.col("_q")[i].alias(l) for i, l in enumerate(quantile_labels(qs))])


# --- importance, serving -------------------------------------------------------

def correlation_importance(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """|corr(feature, target)| for all features in one aggregation, long form."""
    row = df.agg(*[F.abs(pearson(f, target)).alias(f) for f in features])
    stack = ", ".join(f"'{f}', `{f}`" for f in features)
    return row.selectExpr(f"stack({len(features)}, {stack}) as (feature, importance)")


def top_k(df: DataFrame, k: int, by: str = "importance", tiebreak: str = "feature", digits: int = 10) -> DataFrame:
    """Top ``k`` rows by ``by`` (rounded to ``digits`` so float noise cannot
    reorder equal scores), ties by ``tiebreak``; distributed top-k."""
    return df.orderBy(F.round(by, digits).desc_nulls_last(), F.col(tiebreak)).limit(k)


def batch_forecast(requests: DataFrame, bins: DataFrame, keys: Sequence[str] = ("plant_type", "month", "hour"),
                   capacity: str | float = C.DEFAULT_CAPACITY, digits: int = 2) -> DataFrame:
    """Score request rows: cyclical features, bin quantiles, fallback
    interval, uncertainty range, confidence, half-even rounding."""
    from wattline.functions.calendar import cyclical_columns
    r = requests.withColumns(cyclical_columns("hour", "month", None))
    p = r.join(bins, on=list(keys), how="left")
    lo, hi = FF.interval_fallback("P50", "P10", "P90", C.INTERVAL_FALLBACK)
    p = p.withColumns({"P10": lo, "P90": hi})
    rng = FF.uncertainty_range("P10", "P90")
    p = p.withColumn("uncertainty_range", rng).withColumn("confidence_level", FF.confidence_level("uncertainty_range", capacity))
    return p.withColumns({c: FF.round_half_even(c, digits) for c in ("P10", "P50", "P90", "uncertainty_range")})


# --- Spark ML trees ------------------------------------------------------------

def fit_gbt(train: DataFrame, features: Sequence[str], label: str = "y_true", max_iter: int = 100,
            seed: int = 42, loss: str = "squared"):
    """VectorAssembler (+ mean imputation of nulls) + GBTRegressor."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    imputed = [f"{f}__imp" for f in features]
    stages = [
        Imputer(inputCols=list(features), outputCols=imputed, strategy="mean"),
        VectorAssembler(inputCols=imputed, outputCol="_features", handleInvalid="keep"),
        GBTRegressor(featuresCol="_features", labelCol=label, predictionCol="P50", maxIter=max_iter, seed=seed,
                     lossType=loss),
    ]
    data = train.filter(F.col(label).isNotNull())
    for f in features:
        data = data.withColumn(f, F.col(f).cast("double"))
    return Pipeline(stages=stages).fit(data)


def gbt_predict(model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    for f in features:
        df = df.withColumn(f, F.col(f).cast("double"))
    out = model.transform(df)
    return out.drop("_features", *[f"{f}__imp" for f in features])


def gbt_importance(model, features: Sequence[str]):
    """(feature, importance) pairs, descending (driver-side: one per feature)."""
    imp = model.stages[-1].featureImportances.toArray()
    return sorted(zip(features, [float(x) for x in imp], strict=True), key=lambda t: (-t[1], t[0]))


def conformal_intervals(point_val: DataFrame, point_test: DataFrame, keys: Sequence[str] = ("plant_name",),
                        y: str = "y_true", qs=(0.1, 0.9)) -> DataFrame:
    """Split conformal: the validation residuals of ranks floor((n+1)*q_lo)
    and ceil((n+1)*q_hi) per key (within 1..n), added to the test forecast."""
    res = point_val.select(*keys, (F.col(y) - F.col("P50")).alias("_res"))
    got = values_at(res, keys, "_res", {
        "_r0": lambda n: F.greatest(F.floor((n + 1) * F.lit(qs[0])), F.lit(1)) - 1,
        "_r1": lambda n: F.least(F.ceil((n + 1) * F.lit(qs[1])), n) - 1})
    j = point_test.join(got.select(*keys, "_r0", "_r1"), on=list(keys), how="left")
    return j.withColumn("P10", F.col("P50") + F.col("_r0")).withColumn("P90", F.col("P50") + F.col("_r1")).drop("_r0", "_r1")

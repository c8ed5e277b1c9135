"""Baselines and forecast metrics as grouped aggregations.

Metrics take a long prediction table (one row per model x key x time with
``y_true`` and the forecast columns) and compute everything in a single
``groupBy(model[, plant]).agg(...)`` pass: the aggregation is partial on the
map side, so only one small row per group and partition is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline import config as C
from wattline.functions.stats import crps_gaussian
from wattline.operators.windows import halo_window

POINT = ("mae", "rmse", "mape", "smape", "nmae", "nrmse", "cf_mae")
PROB = ("picp_80", "mpiw_80", "nmpiw_80", "pinaw_80", "cwc_80", "pinball_p10", "pinball_p50", "pinball_p90",
        "pinball_avg", "crps")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- baselines ---------------------------------------------------------------

def baseline_shift(df: DataFrame, y: str, h: int, keys: Sequence[str] = ("plant_name",), rn: str = "rn",
                   out: str = "y_pred", bucket_rows: int = 1 << 16) -> DataFrame:
    """``y`` shifted by ``h`` rows per key; the first ``h`` rows take the
    series' first value (shift + backfill).  Needs ``rn`` (row_index): a halo
    window over blocks of positions, so a long series is many tasks."""
    lagged = halo_window(df, keys, rn, lambda w: [F.lag(F.col(y), h).over(w).alias("_lag")], back=h,
                         bucket_hours=max(h, bucket_rows), index_col=rn, order=[rn])
    first = df.groupBy(*keys).agg(F.min(F.struct(F.col(rn), F.col(y)))[y].alias("_first"))
    return lagged.join(first, on=list(keys), how="left") \
        .withColumn(out, F.coalesce(F.col("_lag"), F.col("_first"))).drop("_lag", "_first")


def baseline_persistence(df, y="y_true", horizon: int = 1, **kw) -> DataFrame:
    return baseline_shift(df, y, horizon, **kw)


def baseline_seasonal_naive(df, y="y_true", season: int = 24, **kw) -> DataFrame:
    return baseline_shift(df, y, season, **kw)


def baseline_climatology(df: DataFrame, y: str = "y_true", freq: str = "D", keys: Sequence[str] = ("plant_name",),
                         ts: str = "timestamp", out: str = "y_pred", fit: DataFrame | None = None) -> DataFrame:
    """Mean of ``y`` by hour of day (``H``), day of year (``D``) or overall,
    per key; in-sample unless ``fit`` is given.  Aggregate + join, no
    window over a possibly hot key."""
    if freq == "H":
        g = [F.hour(ts).alias("_g")]
    elif freq == "D":
        g = [F.dayofyear(ts).alias("_g")]
    else:
        g = [F.lit(0).alias("_g")]
    src = df if fit is None else fit
    means = src.groupBy(*keys, *g).agg(F.avg(y).alias(out))
    return df.withColumn("_g", g[0]).join(means, on=[*keys, "_g"], how="left").drop("_g")


# --- metrics -------------------------------------------------------------------

def point_metric_aggs(y="y_true", p="P50", zero_value: float | None = None) -> list[Column]:
    yt, yp = _c(y), _c(p)
    both = yt.isNotNull() & yp.isNotNull()
    e = F.when(both, yt - yp)
    ymape = yt if zero_value is None else F.when(yt == 0, F.lit(zero_value)).otherwise(yt)
    ape = F.try_divide(F.abs(e), F.abs(F.when(both & (ymape != 0), ymape)))
    sden = F.abs(yt) + F.abs(yp)
    sape = F.try_divide(F.lit(2.0) * F.abs(e), F.when(both & (sden != 0), sden))
    mae = F.avg(F.abs(e))
    rmse = F.sqrt(F.avg(e * e))
    ymean = F.avg(F.when(both, yt))
    ymax = F.max(F.when(both, yt))
    return [
        mae.alias("mae"),
        rmse.alias("rmse"),
        (F.avg(ape) * F.lit(100.0)).alias("mape"),
        (F.avg(sape) * F.lit(100.0)).alias("smape"),
        F.try_divide(mae, ymean).alias("nmae"),
        F.try_divide(rmse, ymean).alias("nrmse"),
        F.try_divide(mae, ymax).alias("cf_mae"),
    ]


def _pinball(y: Column, q_pred: Column, q: float) -> Column:
    e = y - q_pred
    return F.greatest(F.lit(q) * e, F.lit(q - 1.0) * e)


def prob_metric_aggs(y="y_true", p10="P10", p50="P50", p90="P90", gamma: float = C.PICP_TARGET,
                     eta: float = C.CWC_ETA, z: float = C.Z80) -> list[Column]:
    yt, lo, md, hi = _c(y), _c(p10), _c(p50), _c(p90)
    ok = yt.isNotNull() & lo.isNotNull() & md.isNotNull() & hi.isNotNull()
    ytk = F.when(ok, yt)
    picp = F.avg(F.when(ok, ((yt >= lo) & (yt <= hi)).cast("double")))
    mpiw = F.avg(F.when(ok, hi - lo))
    rng = F.max(ytk) - F.min(ytk)
    nmpiw = F.try_divide(mpiw, rng)
    cwc = nmpiw * (F.lit(1.0) + F.lit(eta) * F.pow(F.greatest(F.lit(0.0), F.lit(gamma) - picp), 2))
    pb10 = F.avg(F.when(ok, _pinball(yt, lo, 0.1)))
    pb50 = F.avg(F.when(ok, _pinball(yt, md, 0.5)))
    pb90 = F.avg(F.when(ok, _pinball(yt, hi, 0.9)))
    sigma = (hi - lo) / F.lit(2.0 * z)
    crps = F.avg(F.when(ok, crps_gaussian(yt, md, sigma)))
    return [
        picp.alias("picp_80"), mpiw.alias("mpiw_80"), nmpiw.alias("nmpiw_80"), nmpiw.alias("pinaw_80"),
        cwc.alias("cwc_80"), pb10.alias("pinball_p10"), pb50.alias("pinball_p50"), pb90.alias("pinball_p90"),
        ((pb10 + pb50 + pb90) / F.lit(3.0)).alias("pinball_avg"), crps.alias("crps"),
    ]


def evaluate_wide(preds: DataFrame, group: Sequence[str] = ("model",), y="y_true", probabilistic: bool = True,
                  flag: str | None = None, **kw) -> DataFrame:
    """One row per group with point (and probabilistic) metrics; ``flag``
    names a column telling whether the group has both interval ends."""
    aggs = point_metric_aggs(y, kw.get("p50", "P50"), kw.get("zero_value"))
    if probabilistic:
        aggs += prob_metric_aggs(y, kw.get("p10", "P10"), kw.get("p50", "P50"), kw.get("p90", "P90"),
                                 kw.get("gamma", C.PICP_TARGET), kw.get("eta", C.CWC_ETA))
    if flag:
        aggs.append((F.count_if(F.col("P10").isNotNull()) * F.count_if(F.col("P90").isNotNull()) > 0).alias(flag))
    return preds.groupBy(*group).agg(*aggs)


def to_long(wide: DataFrame, group: Sequence[str] = ("model",), metrics: Sequence[str] | None = None) -> DataFrame:
    """Wide metric row -> (group..., metric, value)."""
    metrics = [m for m in (metrics or [*POINT, *PROB]) if m in wide.columns]
    stack = ", ".join(f"'{m}', cast(`{m}` as double)" for m in metrics)
    return wide.selectExpr(*[f"`{g}`" for g in group], f"stack({len(metrics)}, {stack}) as (metric, value)")


def evaluate_model(preds: DataFrame, group: Sequence[str] = ("model",), y="y_true") -> DataFrame:
    """Long metrics; probabilistic metrics only for groups with all three quantiles."""
    wide = evaluate_wide(preds, group, y, flag="_q")
    return to_long(wide, (*group, "_q")).filter(F.col("metric").isin(*POINT) | F.col("_q")).drop("_q")


def compare_models(long_metrics: DataFrame, group: Sequence[str] = ("model",),
                   metrics: Sequence[str] = (*POINT, *PROB)) -> DataFrame:
    """Model x metric matrix (missing metrics NULL)."""
    return long_metrics.groupBy(*group).pivot("metric", list(metrics)).agg(F.first("value"))


def best_by_metric(long_metrics: DataFrame, maximize: Sequence[str] = ("picp_80",)) -> DataFrame:
    """Best model per metric: max for ``maximize`` metrics, min otherwise;
    ties -> alphabetically first model."""
    v = F.when(F.col("metric").isin(*maximize), -F.col("value")).otherwise(F.col("value"))
    best = long_metrics.filter(F.col("value").isNotNull()).groupBy("metric").agg(
        F.min(F.struct(v.alias("k"), F.col("model"), F.col("value"))).alias("b"))
    return best.select("metric", F.col("b.model").alias("best_model"), F.col("b.value").alias("best_value"),
                       F.when(F.col("metric").isin(*maximize), "max").otherwise("min").alias("direction"))


def reliable_models(long_metrics: DataFrame, min_picp: float = C.RELIABLE_PICP) -> DataFrame:
    """Models with PICP >= threshold, plus best overall (MAE) / probabilistic (pinball)."""
    picp = long_metrics.filter((F.col("metric") == "picp_80") & (F.col("value") >= min_picp)) \
        .select(F.lit("reliable").alias("role"), "model", "value")
    best = best_by_metric(long_metrics.filter(F.col("metric").isin("mae", "pinball_avg")))
    roles = best.select(F.when(F.col("metric") == "mae", "best_overall").otherwise("best_probabilistic").alias("role"),
                        F.col("best_model").alias("model"), F.col("best_value").alias("value"))
    return picp.unionByName(roles)


def evaluation_report(long_metrics: DataFrame, min_picp: float = C.RELIABLE_PICP) -> DataFrame:
    """The report's lines (section, item, model, value): the comparison, the
    best model by metric, the interval analysis (lowest pinball loss, else
    the highest value) and the recommendations (best overall by MAE, best
    probabilistic by pinball loss, models with enough coverage)."""
    known = long_metrics.filter(F.col("value").isNotNull())
    lines = known.select(F.lit("comparison").alias("section"), F.col("metric").alias("item"), "model", "value")
    best = best_by_metric(known).select(F.lit("best").alias("section"), F.col("metric").alias("item"), F.col("best_model").alias("model"),
                                        F.col("best_value").alias("value"))
    high = best_by_metric(known.filter(F.col("metric").isin("picp_80", "mpiw_80", "pinball_avg")), maximize=("picp_80", "mpiw_80"))
    high = high.select(F.lit("probabilistic").alias("section"), F.col("metric").alias("item"), F.col("best_model").alias("model"),
                       F.col("best_value").alias("value"))
    advice = reliable_models(known, min_picp).select(F.lit("recommendation").alias("section"), F.col("role").alias("item"), "model", "value")
    return lines.unionByName(best).unionByName(high).unionByName(advice)


def clip_interval(df: DataFrame) -> DataFrame:
    """Enforce P10 <= P50 <= P90 (quantile crossing repair)."""
    lo = F.least("P10", "P50", "P90")
    hi = F.greatest("P10", "P50", "P90")
    mid = F.col("P10") + F.col("P50") + F.col("P90") - lo - hi
    return df.withColumns({"P10": lo, "P50": mid, "P90": hi})


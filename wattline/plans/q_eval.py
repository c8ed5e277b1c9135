"""Registered queries: splits, baselines, metrics, forecasters, ensembles."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from wattline import config as C
from wattline.functions import stats as S
from wattline.operators import evaluation as E
from wattline.operators import forecasting as FC
from wattline.operators.align import resample_hourly
from wattline.operators.series import row_index, split_chronological, split_random, split_timeseries_cv
from wattline.plans import oracle as O
from wattline.plans.q_core import GEN_HOURLY
from wattline.plans.registry import register, tables
from wattline.session import materialize

TB = ("event_id",)
MODELS = ("Persistence", "Climatology", "Seasonal_Naive", "QuantileBins")


# --- Spark side -----------------------------------------------------------------
def series(spark, sf):
    """Hourly generation per plant (non-null), row positions, 70/20/10 split."""
    gen, _ = tables(spark, sf)
    h = resample_hourly(gen, mean_cols=["generation_mw"], first_cols=("capacity_mw",), tiebreak=TB)
    s = h.filter(F.col("generation_mw").isNotNull()).select(
        "plant_name", "timestamp", "capacity_mw", F.col("generation_mw").alias("y_true"))
    return split_chronological(row_index(s))


def _test(spark, sf):
    return series(spark, sf).filter(F.col("split") == "test")


def predictions(spark, sf, on: str = "test"):
    """Long prediction table: 3 baselines + quantile bins on the test slice,
    bins fitted on train and val; or on the val slice, fitted on train.

    The hourly series feeds every model (about six branches of the plan), so
    it is written once, as Parquet, instead of being recomputed."""
    s = materialize(series(spark, sf))
    test = s.filter(F.col("split") == on).select("plant_name", "timestamp", "y_true", "rn_split")
    pers = E.baseline_persistence(test, rn="rn_split", out="P50")
    seas = E.baseline_seasonal_naive(test, rn="rn_split", out="P50")
    clim = E.baseline_climatology(test, out="P50")
    hist = FC.add_month_hour(s.filter(F.col("split").isin(*(("train", "val") if on == "test" else ("train",)))))
    bins = FC.fit_quantile_bins(hist)
    qb = FC.predict_quantile_bins(FC.add_month_hour(test), bins)
    cols = ["plant_name", "timestamp", "y_true"]
    nul = F.lit(None).cast("double")
    parts = [
        pers.select(F.lit("Persistence").alias("model"), *cols, nul.alias("P10"), "P50", nul.alias("P90")),
        clim.select(F.lit("Climatology").alias("model"), *cols, nul.alias("P10"), "P50", nul.alias("P90")),
        seas.select(F.lit("Seasonal_Naive").alias("model"), *cols, nul.alias("P10"), "P50", nul.alias("P90")),
        qb.select(F.lit("QuantileBins").alias("model"), *cols, "P10", "P50", "P90"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- oracle side -----------------------------------------------------------------
SERIES = GEN_HOURLY + """,
series0 as (select plant_name, timestamp, capacity_mw, generation_mw as y_true from gen_hourly where generation_mw is not null),
series1 as (select *, row_number() over (partition by plant_name order by timestamp) as rn,
  count(*) over (partition by plant_name) as n from series0),
series as (select plant_name, timestamp, capacity_mw, y_true, rn,
  case when rn <= floor(n * 0.7::double) then 'train' when rn <= floor(n * 0.7::double) + floor(n * 0.2::double) then 'val' else 'test' end as split,
  cast(rn - case when rn <= floor(n * 0.7::double) then 0 when rn <= floor(n * 0.7::double) + floor(n * 0.2::double) then floor(n * 0.7::double)
       else floor(n * 0.7::double) + floor(n * 0.2::double) end as bigint) as rn_split from series1),
test as (select plant_name, timestamp, y_true, rn_split from series where split = 'test'),
bins as (select plant_name, cast(month(timestamp) as integer) as month, cast(hour(timestamp) as integer) as hour,
  quantile_cont(y_true, [0.1, 0.5, 0.9]) as q from series where split in ('train', 'val') group by all),
preds as (
  select 'Persistence' as model, plant_name, timestamp, y_true, cast(null as double) as P10,
    coalesce(lag(y_true, 1) over w, first_value(y_true) over w) as P50, cast(null as double) as P90
    from test window w as (partition by plant_name order by rn_split)
  union all
  select 'Climatology', plant_name, timestamp, y_true, null,
    avg(y_true) over (partition by plant_name, dayofyear(timestamp)), null from test
  union all
  select 'Seasonal_Naive', plant_name, timestamp, y_true, null,
    coalesce(lag(y_true, 24) over w, first_value(y_true) over w), null
    from test window w as (partition by plant_name order by rn_split)
  union all
  select 'QuantileBins', t.plant_name, t.timestamp, t.y_true, b.q[1], b.q[2], b.q[3]
    from test t left join bins b on t.plant_name = b.plant_name
      and cast(month(t.timestamp) as integer) = b.month and cast(hour(t.timestamp) as integer) = b.hour)"""


_BRANCH = SERIES[SERIES.index("test as ("):]
#: the same predictions on the validation slice
SERIES_VAL = SERIES + ",\n" + (_BRANCH.replace("test as (", "val_rows as (").replace("split = 'test'", "split = 'val'")
                                .replace("from test", "from val_rows").replace("('train', 'val')", "('train')")
                                .replace("bins as (", "bins_val as (").replace("join bins b", "join bins_val b")
                                .replace("preds as (", "preds_val as ("))


def _erf_sql(x: str) -> str:
    a1, a2, a3, a4, a5 = S.AS_A
    t = f"(1.0 / (1.0 + {S.AS_P} * abs({x})))"
    poly = f"({t} * ({a1} + {t} * ({a2} + {t} * ({a3} + {t} * ({a4} + {t} * {a5})))))"
    y = f"(1.0 - {poly} * exp(-(abs({x}) * abs({x}))))"
    return f"(case when {x} >= 0 then {y} else -{y} end)"


def _crps_sql(y="y_true", md="P50", lo="P10", hi="P90") -> str:
    s = f"(({hi} - {lo}) / {2.0 * C.Z80})"
    z = f"(({y} - {md}) / nullif({s}, 0))"
    cdf = f"(0.5 * (1.0 + {_erf_sql(f'({z} / {math.sqrt(2.0)})')}))"
    pdf = f"(exp(-0.5 * {z} * {z}) / {math.sqrt(2.0 * math.pi)})"
    val = f"{s} * ({z} * (2.0 * {cdf} - 1.0) + 2.0 * {pdf} - {1.0 / math.sqrt(math.pi)})"
    return f"(case when {s} > 0 then {val} else abs({y} - {md}) end)"


def _metrics_sql(group="model") -> str:
    e = "case when y_true is not null and P50 is not null then y_true - P50 end"
    both = "y_true is not null and P50 is not null"
    ok = "y_true is not null and P10 is not null and P50 is not null and P90 is not null"
    mae = f"avg(abs({e}))"
    rmse = f"sqrt(avg(({e}) * ({e})))"
    ymean = f"avg(case when {both} then y_true end)"
    ymax = f"max(case when {both} then y_true end)"
    picp = f"avg(case when {ok} then (case when y_true >= P10 and y_true <= P90 then 1.0 else 0.0 end) end)"
    mpiw = f"avg(case when {ok} then P90 - P10 end)"
    rng = f"(max(case when {ok} then y_true end) - min(case when {ok} then y_true end))"
    nmpiw = f"({mpiw} / nullif({rng}, 0))"

    def pb(q, col):
        return f"avg(case when {ok} then greatest({q} * (y_true - {col}), {q - 1.0} * (y_true - {col})) end)"

    return f"""select {group},
  {mae} as mae, {rmse} as rmse,
  avg(abs({e}) / nullif(abs(case when {both} and y_true <> 0 then y_true end), 0)) * 100.0 as mape,
  avg(2.0 * abs({e}) / nullif(case when {both} then abs(y_true) + abs(P50) end, 0)) * 100.0 as smape,
  {mae} / nullif({ymean}, 0) as nmae, {rmse} / nullif({ymean}, 0) as nrmse, {mae} / nullif({ymax}, 0) as cf_mae,
  {picp} as picp_80, {mpiw} as mpiw_80, {nmpiw} as nmpiw_80, {nmpiw} as pinaw_80,
  {nmpiw} * (1.0 + {C.CWC_ETA} * pow(greatest(0.0, {C.PICP_TARGET} - {picp}), 2)) as cwc_80,
  {pb(0.1, 'P10')} as pinball_p10, {pb(0.5, 'P50')} as pinball_p50, {pb(0.9, 'P90')} as pinball_p90,
  ({pb(0.1, 'P10')} + {pb(0.5, 'P50')} + {pb(0.9, 'P90')}) / 3.0 as pinball_avg,
  avg(case when {ok} then {_crps_sql()} end) as crps
from preds group by {group}"""


METRICS_WIDE = _metrics_sql()
LONG = ("metrics_long as (select model, metric, value from (select * from metrics_wide) "
        "unpivot (value for metric in (" + ", ".join(E.POINT + E.PROB) + ")) where "
        "metric in (" + ", ".join(f"'{m}'" for m in E.POINT) + ") or model = 'QuantileBins')")
# note: DuckDB unpivot drops NULL values; the Spark side keeps NULL metrics of a
# quantile model, so queries below only use metrics that are non-null here.


def _q(body: str, extra: str = "", doubles=()) -> str:
    ctes = SERIES + (",\n" + extra if extra else "")
    return O.wrap(O.with_adapter(body, ctes), list(doubles))


# --- splits & baselines ------------------------------------------------------
@register("split_chronological", _q("select plant_name, timestamp, y_true, rn, split, rn_split from series", doubles=["y_true"]))
def q_split_chronological(spark, sf):
    return series(spark, sf).select("plant_name", "timestamp", "y_true", "rn", "split", "rn_split")


_CV = ("select plant_name, timestamp, rn, case when rn > n - floor(n / 4) then 'val' else 'train' end as fold "
       "from series1")


@register("split_timeseries_cv", _q(_CV))
def q_split_timeseries_cv(spark, sf):
    gen, _ = tables(spark, sf)
    h = resample_hourly(gen, mean_cols=["generation_mw"], first_cols=(), tiebreak=TB)
    s = row_index(h.filter(F.col("generation_mw").isNotNull()).select("plant_name", "timestamp"))
    return split_timeseries_cv(s).select("plant_name", "timestamp", "rn", "fold")


_SR = O.with_adapter("select event_id, case when ((event_id % 1000003 * 2654435761 + 42) % 1000003) % 100 < 80 "
                     "then 'train' else 'test' end as split from generation")


@register("split_random", _SR)
def q_split_random(spark, sf):
    gen, _ = tables(spark, sf)
    return split_random(gen.select("event_id"), "event_id", 42, 80)


def _baseline_sql(model):
    return _q(f"select plant_name, timestamp, y_true, P50 as y_pred from preds where model = '{model}'",
              doubles=["y_true", "y_pred"])


def _baseline(spark, sf, fn):
    test = _test(spark, sf).select("plant_name", "timestamp", "y_true", "rn_split")
    return fn(test).select("plant_name", "timestamp", "y_true", "y_pred")


@register("baseline_persistence", _baseline_sql("Persistence"))
def q_baseline_persistence(spark, sf):
    return _baseline(spark, sf, lambda t: E.baseline_persistence(t, rn="rn_split"))


@register("baseline_seasonal_naive", _baseline_sql("Seasonal_Naive"))
def q_baseline_seasonal_naive(spark, sf):
    return _baseline(spark, sf, lambda t: E.baseline_seasonal_naive(t, rn="rn_split"))


@register("baseline_climatology", _baseline_sql("Climatology"))
def q_baseline_climatology(spark, sf):
    return _baseline(spark, sf, lambda t: E.baseline_climatology(t))


def _climatology(group):
    return _q(f"select plant_name, timestamp, y_true, avg(y_true) over (partition by plant_name{group}) as y_pred from test",
              doubles=["y_true", "y_pred"])


@register("baseline_climatology_hour", _climatology(", hour(timestamp)"))
def q_baseline_climatology_hour(spark, sf):
    return _baseline(spark, sf, lambda t: E.baseline_climatology(t, freq="H"))


@register("baseline_climatology_overall", _climatology(""))
def q_baseline_climatology_overall(spark, sf):
    return _baseline(spark, sf, lambda t: E.baseline_climatology(t, freq="all"))


@register("forecast_quantile_bins", _q("select plant_name, timestamp, y_true, P10, P50, P90 from preds "
                                        "where model = 'QuantileBins'", doubles=["y_true", "P10", "P50", "P90"]))
def q_forecast_quantile_bins(spark, sf):
    return predictions(spark, sf).filter(F.col("model") == "QuantileBins").drop("model")


# --- metrics -------------------------------------------------------------------
def _metric_query(name, cols, models=MODELS):
    mlist = ", ".join(f"'{m}'" for m in models)
    body = f"select model, {', '.join(cols)} from metrics_wide where model in ({mlist})"

    @register(name, _q(body, "metrics_wide as (" + METRICS_WIDE + ")", cols))
    def q(spark, sf):
        w = E.evaluate_wide(predictions(spark, sf))
        return w.filter(F.col("model").isin(*models)).select("model", *cols)
    return q


_metric_query("metric_mae_rmse", ["mae", "rmse"])
_metric_query("metric_mape", ["mape"])
_metric_query("metric_smape", ["smape"])
_metric_query("metric_normalised", ["nmae", "nrmse", "cf_mae"])
_metric_query("metric_picp", ["picp_80"], ("QuantileBins",))
_metric_query("metric_width", ["mpiw_80", "nmpiw_80", "pinaw_80"], ("QuantileBins",))
_metric_query("metric_cwc", ["cwc_80"], ("QuantileBins",))
_metric_query("metric_pinball", ["pinball_p10", "pinball_p50", "pinball_p90", "pinball_avg"], ("QuantileBins",))
_metric_query("metric_crps", ["crps"], ("QuantileBins",))

_MW = "metrics_wide as (" + METRICS_WIDE + "),\n" + LONG


@register("eval_model", _q("select model, metric, value from metrics_long where model = 'QuantileBins'", _MW, ["value"]))
def q_eval_model(spark, sf):
    return E.evaluate_model(predictions(spark, sf).filter(F.col("model") == "QuantileBins"))


@register("eval_baselines", _q("select model, metric, value from metrics_long where model <> 'QuantileBins'", _MW, ["value"]))
def q_eval_baselines(spark, sf):
    p = predictions(spark, sf).filter(F.col("model") != "QuantileBins")
    return E.to_long(E.evaluate_wide(p, probabilistic=False), metrics=E.POINT)


_PIV = ", ".join(f"max(case when metric = '{m}' then value end) as {m}" for m in E.POINT + E.PROB)


@register("union_metrics", _q(f"select model, {_PIV} from metrics_long group by model", _MW, list(E.POINT + E.PROB)))
def q_union_metrics(spark, sf):
    """Baseline (point only) and model metrics stacked, then model x metric."""
    p = predictions(spark, sf)
    base = E.to_long(E.evaluate_wide(p.filter(F.col("model") != "QuantileBins"), probabilistic=False), metrics=E.POINT)
    model = E.evaluate_model(p.filter(F.col("model") == "QuantileBins"))
    return E.compare_models(base.unionByName(model))


_BEST = ("select metric, arg_min(model, struct_pack(k := case when metric = 'picp_80' then -value else value end, m := model)) as best_model, "
         "arg_min(value, struct_pack(k := case when metric = 'picp_80' then -value else value end, m := model)) as best_value, "
         "case when metric = 'picp_80' then 'max' else 'min' end as direction from metrics_long where value is not null group by metric")


@register("best_by_metric", _q(_BEST, _MW, ["best_value"]))
def q_best_by_metric(spark, sf):
    return E.best_by_metric(E.evaluate_model(predictions(spark, sf)))


_REL = (f"select 'reliable' as role, model, value from metrics_long where metric = 'picp_80' and value >= {C.RELIABLE_PICP} "
        "union all select case when metric = 'mae' then 'best_overall' else 'best_probabilistic' end, best_model, best_value "
        f"from ({_BEST}) where metric in ('mae', 'pinball_avg')")


@register("reliable_models", _q(_REL, _MW, ["value"]))
def q_reliable_models(spark, sf):
    return E.reliable_models(E.evaluate_model(predictions(spark, sf)))

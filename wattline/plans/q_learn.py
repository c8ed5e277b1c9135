"""Registered queries: learners for each plant, recursion, draws, drift and ramps."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.operators import events as EV
from wattline.operators import forecasting as FC
from wattline.operators import learners as L
from wattline.operators.series import split_random
from wattline.plans import oracle as O
from wattline.plans.q_core import GEN_HOURLY
from wattline.plans.q_eval import SERIES, SERIES_VAL, predictions, series
from wattline.plans.q_misc import _merged
from wattline.plans.registry import register, tables
from wattline.operators.align import resample_hourly
from wattline.operators.joins import join_predictions
from wattline.session import materialize

KEY = ["plant_name"]
FEATURES = ["wind_speed", "surface_solar_radiation_downwards", "total_cloud_cover", "hour_sin", "hour_cos"]
LAGS = (1, 2, 3, 24)
LAG_NAMES = [f"lag_{n}" for n in LAGS]
REACH, STEPS, DRAWS, SEED = max(LAGS), 24, 50, 42


# --- a learner for each plant -----------------------------------------------------
def _plant_frame(spark, sf):
    angle = F.hour("timestamp").cast("double") * F.lit(float(O.TWO_PI)) / F.lit(24.0)
    m = _merged(spark, sf).withColumns({"hour_sin": F.sin(angle), "hour_cos": F.cos(angle)}).withColumnRenamed("generation_mw", "y_true")
    return split_random(m, "event_id")


_HOUR = f"{O.TWO_PI} * cast(hour(timestamp) as double) / 24.0"
_FRAME = (f"frame as (select event_id, plant_name, timestamp, generation_mw as y_true, wind_speed, surface_solar_radiation_downwards, total_cloud_cover, "
          f"sin({_HOUR}) as hour_sin, cos({_HOUR}) as hour_cos, case when ((event_id % 1000003 * 2654435761 + 42) % 1000003) % 100 < 80 then 'train' else 'test' end "
          "as split from merged),\ntrain as (select * from frame where split = 'train')")
_PLANT = O.merged_ctes() + ",\n" + _FRAME + ",\n" + O.linear_ctes("fitted", "train", "y_true", FEATURES)


@register("learner_weights", O.wrap(O.with_adapter(
    " union all ".join(f"select plant_name, n, '{name}' as feature, {col} as weight from fitted"
                       for name, col in [("intercept", "intercept"), *[(f, f"w{i}") for i, f in enumerate(FEATURES)]]), _PLANT), ["weight"]))
def q_learner_weights(spark, sf):
    """Least-squares weights of every plant, from one grouped aggregate."""
    train = _plant_frame(spark, sf).filter(F.col("split") == "train")
    return L.weights_long(L.fit_linear(train, KEY, "y_true", FEATURES), KEY, FEATURES)


@register("forecast_point_plant", O.wrap(O.with_adapter(
    f"select event_id, f.plant_name, timestamp, y_true, {O.linear_sql(FEATURES, 'm')} as P50 from frame f left join fitted m "
    "on f.plant_name = m.plant_name where split = 'test'", _PLANT), ["y_true", "P50"]))
def q_forecast_point_plant(spark, sf):
    """Every plant's own model applied to its test rows."""
    d = _plant_frame(spark, sf)
    model = L.fit_linear(d.filter(F.col("split") == "train"), KEY, "y_true", FEATURES)
    out = L.predict_linear(d.filter(F.col("split") == "test"), model, KEY, FEATURES)
    return out.select("event_id", "plant_name", "timestamp", "y_true", "P50")


# --- recursion over lags ------------------------------------------------------------
def lag_series(spark, sf, ahead: int = 0):
    """The hourly series with row positions and splits, the values before each row and its lags."""
    s = series(spark, sf).select("plant_name", "timestamp", "y_true", "rn", "split")
    return L.lag_columns(L.lag_frame(s, KEY, "rn", "y_true", REACH, ahead), LAGS)


_LAGGED = ("lagged as (select plant_name, timestamp, y_true, rn, split, " + ", ".join(f"lag(y_true, {n}) over w as lag_{n}" for n in LAGS)
           + f", list(y_true) over (partition by plant_name order by rn rows between {REACH} preceding and current row) as state "
           "from series window w as (partition by plant_name order by rn))")


def _lag_model(splits: str, name: str) -> str:
    return f"{name}_rows as (select * from lagged where split in ({splits})),\n" + O.linear_ctes(name, f"{name}_rows", "y_true", LAG_NAMES)


_NEXT = " + ".join(["intercept", *[f"w{i} * acc[-{n}]" for i, n in enumerate(LAGS)]])
_ROLL = f"""roll as (
  select l.plant_name, l.timestamp, l.rn, 0 as step, l.state as acc, m.intercept, {', '.join(f'm.w{i}' for i in range(len(LAGS)))}
    from lagged l join ar m on l.plant_name = m.plant_name where l.split = 'test' and len(l.state) >= {REACH}
  union all
  select plant_name, timestamp, rn, step + 1, list_append(acc, {_NEXT}), intercept, {', '.join(f'w{i}' for i in range(len(LAGS)))}
    from roll where step < {STEPS}),
steps as (select r.plant_name, r.timestamp as origin, r.step, r.acc[-1] as P50, s.y_true from roll r
  left join series s on s.plant_name = r.plant_name and s.rn = r.rn + r.step where r.step > 0)"""


def _recursive(body: str, doubles) -> str:
    """The oracle's recursion runs in SQL too."""
    sql = O.with_adapter(body, SERIES + ",\n" + _LAGGED + ",\n" + _lag_model("'train', 'val'", "ar") + ",\n" + _ROLL)
    return O.wrap("with recursive" + sql[len("with"):], doubles)


def recursive_steps(spark, sf):
    d = lag_series(spark, sf, ahead=STEPS)
    model = L.fit_linear(d.filter(F.col("split").isin("train", "val")), KEY, "y_true", LAG_NAMES)
    origins = d.filter(F.col("split") == "test").withColumn("state", F.concat("before", F.array("y_true")))
    rolled = L.forecast_recursive(origins.withColumnRenamed("timestamp", "origin"), model, KEY, LAGS, "state", STEPS)
    return L.by_step(rolled, ["plant_name", "origin"])


@register("forecast_recursive", _recursive("select plant_name, origin, step, P50, y_true from steps", ["P50", "y_true"]))
def q_forecast_recursive(spark, sf):
    """24 steps from every test row: each plant's lag model rolled forward on its own forecasts."""
    return recursive_steps(spark, sf).select("plant_name", "origin", "step", "P50", "y_true")


@register("recursive_error_by_step", _recursive(
    "select step, count(*) as n, avg(abs(y_true - P50)) as mae, sqrt(avg((y_true - P50) * (y_true - P50))) as rmse, avg(y_true - P50) as bias "
    "from steps where y_true is not null and P50 is not null group by step", ["mae", "rmse", "bias"]))
def q_recursive_error_by_step(spark, sf):
    """Error of the rolled forecasts by step."""
    return L.error_by_step(recursive_steps(spark, sf))


# --- draws ------------------------------------------------------------------------------
def lag_forecasts(spark, sf):
    """One-step forecasts of each plant's lag model (fitted on the train slice) on val and test."""
    d = lag_series(spark, sf)
    model = L.fit_linear(d.filter(F.col("split") == "train"), KEY, "y_true", LAG_NAMES)
    return L.predict_linear(d.filter(F.col("split") != "train"), model, KEY, LAG_NAMES).select("plant_name", "timestamp", "rn", "split", "y_true", "P50")


_ONE = (SERIES + ",\n" + _LAGGED + ",\n" + _lag_model("'train'", "one")
        + f",\none_step as (select l.plant_name, timestamp, rn, split, y_true, {O.linear_sql(LAG_NAMES, 'm')} as P50 from lagged l left join one m "
          "on l.plant_name = m.plant_name where split <> 'train')")


def draw_number(draw):
    """A number in [0, 1) for each row position and draw, which SQL can repeat."""
    return F.pmod(F.pmod(F.col("rn") * 7919 + draw * 104729 + SEED, F.lit(1000003)) * F.lit(2654435761), F.lit(1000003)) / F.lit(1000003.0)


_DRAWS = _ONE + f""",
resid as (select plant_name, y_true - P50 as residual, row_number() over (partition by plant_name order by y_true - P50, timestamp) - 1 as rank,
  count(*) over (partition by plant_name) as size from one_step where split = 'val' and y_true - P50 is not null),
sizes as (select distinct plant_name, size from resid),
drawn as (select t.plant_name, t.timestamp, t.P50 + r.residual as value from (select o.*, s.size, unnest(generate_series(0, {DRAWS - 1})) as draw
    from one_step o left join sizes s on o.plant_name = s.plant_name where split = 'test') t
  left join resid r on r.plant_name = t.plant_name
    and r.rank = cast(floor((((t.rn * 7919 + t.draw * 104729 + {SEED}) % 1000003 * 2654435761) % 1000003 / 1000003.0) * t.size) as bigint))"""


@register("forecast_draws", O.wrap(O.with_adapter(
    "select plant_name, timestamp, count(value) as draws, avg(value) as mean, stddev_pop(value) as std, quantile_cont(value, 0.1) as P10, "
    "quantile_cont(value, 0.5) as P50, quantile_cont(value, 0.9) as P90 from drawn group by plant_name, timestamp", _DRAWS), ["mean", "std", "P10", "P50", "P90"]))
def q_forecast_draws(spark, sf):
    """50 draws for each test row from its plant's residuals, and their mean, spread and quantiles."""
    f = materialize(lag_forecasts(spark, sf))
    residuals = FC.residual_table(f.filter(F.col("split") == "val"))
    drawn = FC.forecast_draws(f.filter(F.col("split") == "test").select("plant_name", "timestamp", "rn", "P50"), residuals, draws=DRAWS, uniform=draw_number)
    stats = FC.sample_quantiles(drawn, ["plant_name", "timestamp"], "value")
    counts = drawn.groupBy("plant_name", "timestamp").agg(F.count("value").alias("draws"))
    return stats.join(counts, ["plant_name", "timestamp"]).select("plant_name", "timestamp", "draws", "mean", "std", "P10", "P50", "P90")


# --- quantile learner (iterative: no SQL) ------------------------------------------------
@register("forecast_quantile_linear")
def q_forecast_quantile_linear(spark, sf):
    """P10/P50/P90 of each plant's linear models by pinball loss over lags and the hour, on the test slice."""
    return quantile_forecasts(spark, sf).select("plant_name", "timestamp", "y_true", "P10", "P50", "P90")


def quantile_forecasts(spark, sf):
    angle = F.hour("timestamp").cast("double") * F.lit(float(O.TWO_PI)) / F.lit(24.0)
    d = lag_series(spark, sf).withColumns({"hour_sin": F.sin(angle), "hour_cos": F.cos(angle)})
    feats = ["lag_1", "lag_24", "hour_sin", "hour_cos"]
    d = materialize(d.select("plant_name", "timestamp", "y_true", "split", *feats))
    model = L.fit_quantiles(d.filter(F.col("split") != "test"), KEY, "y_true", feats, tol=2e-3)
    return L.predict_quantiles(d.filter(F.col("split") == "test"), model, KEY, feats)


# --- weights of three models -----------------------------------------------------------
THREE = ["Climatology", "Persistence", "QuantileBins"]
_WIDE3 = ("wide3 as (select plant_name, timestamp, any_value(y_true) as y_true, "
          + ", ".join(f"max(P50) filter (where model = '{m}') as {m}" for m in THREE) + " from preds_val group by plant_name, timestamp)")
_GRID3 = ("grid3 as (select a / 100.0 as w0, b / 100.0 as w1, (100 - a - b) / 100.0 as w2 from (select unnest(generate_series(0, 100)) as a) "
          "cross join (select unnest(generate_series(0, 100)) as b) where a + b <= 100),\n"
          f"maes as (select w0, w1, w2, avg(abs(y_true - (w0 * {THREE[0]} + w1 * {THREE[1]} + w2 * {THREE[2]}))) as mae from wide3 cross join grid3 where "
          + " and ".join(f"{c} is not null" for c in ["y_true", *THREE]) + " group by w0, w1, w2)")


@register("ensemble_weights_three", O.wrap(O.with_adapter(
    f"select w0 as w_{THREE[0]}, w1 as w_{THREE[1]}, w2 as w_{THREE[2]}, mae as val_mae from maes order by mae, w0, w1 limit 1",
    SERIES_VAL + ",\n" + _WIDE3 + ",\n" + _GRID3), [*[f"w_{m}" for m in THREE], "val_mae"]))
def q_ensemble_weights_three(spark, sf):
    """Weights of three models: the whole grid's optimum, by branch and bound."""
    return FC.fit_ensemble_weights(join_predictions(predictions(spark, sf, "val"), THREE), THREE)


# --- drift and ramps -------------------------------------------------------------------
SLACK, LIMIT, RAMP = 0.5, 4.0, 0.25


def drift(spark, sf):
    f = materialize(lag_forecasts(spark, sf)).withColumn("error", F.col("y_true") - F.col("P50"))
    spread = f.filter(F.col("split") == "val").groupBy("plant_name").agg(F.stddev_pop("error").alias("sigma"))
    test = f.filter(F.col("split") == "test").join(spread, "plant_name").withColumns({"slack": SLACK * F.col("sigma"), "limit": LIMIT * F.col("sigma")})
    return EV.cusum(test, "error", KEY, slack="slack", limit="limit")


_DRIFT = _ONE + f""",
spread as (select plant_name, stddev_pop(y_true - P50) as sigma from one_step where split = 'val' group by plant_name),
errors as (select o.plant_name, timestamp, y_true - P50 as error, sigma from one_step o join spread s on o.plant_name = s.plant_name where split = 'test'),
sums as (select *, sum(case when error is null then 0 else error - {SLACK} * sigma end) over w as pu,
  sum(case when error is null then 0 else -error - {SLACK} * sigma end) over w as pd from errors window w as (partition by plant_name order by timestamp)),
cusum as (select plant_name, timestamp, pu - least(0, min(pu) over w) as up, pd - least(0, min(pd) over w) as down, sigma from sums
  window w as (partition by plant_name order by timestamp)),
alarms as (select plant_name, timestamp, up, down, case when up > {LIMIT} * sigma then 'up' when down > {LIMIT} * sigma then 'down' end as alarm from cusum)"""
_ISLANDS = """islands as (select *, sum(case when {label} is not distinct from before{near} and seen then 0 else 1 end) over (partition by plant_name order by timestamp) as run
  from (select *, lag({label}) over w as before, lag(timestamp) over w as prev, lag(true) over w is not null as seen
    from {source} window w as (partition by plant_name order by timestamp)))"""


@register("drift_alarms", O.wrap(O.with_adapter("select plant_name, timestamp, up, down, alarm from alarms", _DRIFT), ["up", "down"]))
def q_drift_alarms(spark, sf):
    """Two-sided CUSUM of each plant's forecast errors, in units of its validation error."""
    return drift(spark, sf).select("plant_name", "timestamp", "up", "down", "alarm")


@register("drift_events", O.with_adapter(
    'select plant_name, alarm, min(timestamp) as start, max(timestamp) as "end", count(*) as rows from islands where alarm is not null group by plant_name, alarm, run',
    _DRIFT + ",\n" + _ISLANDS.format(label="alarm", near="", source="alarms")))
def q_drift_events(spark, sf):
    """Stretches of time in alarm."""
    return EV.runs(drift(spark, sf), "alarm", KEY)


_RAMPS = GEN_HOURLY + f""",
moves as (select plant_name, timestamp, case when timestamp - lag(timestamp) over w <= interval 1 hour then generation_mw - lag(generation_mw) over w end as step, capacity_mw
  from gen_hourly where generation_mw is not null window w as (partition by plant_name order by timestamp)),
steep as (select *, case when step >= {RAMP} * capacity_mw then 'up' when step <= -{RAMP} * capacity_mw then 'down' end as direction from moves),
""" + _ISLANDS.format(label="direction", near=" and timestamp - prev <= interval 1 hour", source="steep")


@register("ramp_events", O.wrap(O.with_adapter(
    'select plant_name, direction, min(timestamp) as start, max(timestamp) as "end", count(*) as rows, sum(step) as size from islands '
    "where direction is not null group by plant_name, direction, run", _RAMPS), ["size"]))
def q_ramp_events(spark, sf):
    """Runs of hours that each change by a quarter of the capacity or more, in one direction."""
    gen, _ = tables(spark, sf)
    h = resample_hourly(gen, mean_cols=["generation_mw"], first_cols=["capacity_mw"], tiebreak=("event_id",)).filter(F.col("generation_mw").isNotNull())
    return EV.ramp_events(h, "generation_mw", RAMP * F.col("capacity_mw"), KEY)

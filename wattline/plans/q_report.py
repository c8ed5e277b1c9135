"""Registered queries: one comparison of all models, the evaluation report, saved state, streamed scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline import config as C
from wattline.operators import evaluation as E
from wattline.operators import forecasting as FC
from wattline.operators import learners as L
from wattline.operators import preprocess as P
from wattline.operators.joins import join_predictions
from wattline.operators.persist import load_model, save_model
from wattline.plans import oracle as O
from wattline.plans.q_eval import METRICS_WIDE, SERIES, SERIES_VAL, predictions, series
from wattline.plans.q_learn import _GRID3, _ONE, _PLANT, _WIDE3, FEATURES, KEY, THREE, _plant_frame, lag_forecasts, quantile_forecasts
from wattline.plans.pipeline import pipeline_features
from wattline.plans.refresh import refresh_features
from wattline.plans.registry import register, tables
from wattline.session import materialize, stage_path
from wattline.sources.sinks import MONTH, write_features, write_report
from wattline.streaming.scoring import batch_writer, read_scores, score

COLS = ["model", "plant_name", "timestamp", "y_true", "P10", "P50", "P90"]


# --- every model in one table -------------------------------------------------------
def compared(spark, sf):
    """Forecasts of the test slice by baselines, bins, each plant's lag model
    with conformal intervals, and the ensemble of three."""
    base = materialize(predictions(spark, sf).select(*COLS))
    lags = materialize(lag_forecasts(spark, sf))
    linear = FC.conformal_intervals(lags.filter(F.col("split") == "val"), lags.filter(F.col("split") == "test"))
    fitted = FC.fit_ensemble_weights(join_predictions(predictions(spark, sf, "val"), THREE), THREE)
    weights = fitted.selectExpr(f"stack({len(THREE)}, " + ", ".join(f"'{m}', w_{m}" for m in THREE) + ") as (model, weight)")
    blend = FC.ensemble_predict(base, F.broadcast(weights))  # one row for each model
    truth = base.filter(F.col("model") == THREE[0]).select("plant_name", "timestamp", "y_true")
    parts = [linear.withColumn("model", F.lit("Lag_Linear")), blend.join(truth, ["plant_name", "timestamp"]).withColumn("model", F.lit("Ensemble"))]
    out = base
    for p in parts:
        out = out.unionByName(p.select(*COLS))
    return out


_BLEND = "(select " + ", ".join(f"w{i} as w_{m}" for i, m in enumerate(THREE)) + " from maes order by mae, w0, w1 limit 1)"
_COMPARED = (SERIES_VAL + ",\n" + _WIDE3 + ",\n" + _GRID3 + ",\n" + _ONE[len(SERIES) + 2:] + f""",
w as {_BLEND},
shares as ({' union all '.join(f"select '{m}' as model, w_{m} as weight from w" for m in THREE)}),
blend0 as (select p.plant_name, p.timestamp, any_value(y_true) as y_true, coalesce(sum(weight * P50) / nullif(sum(weight), 0), avg(P50)) as P50,
  coalesce(avg(P10), coalesce(sum(weight * P50) / nullif(sum(weight), 0), avg(P50)) * {C.INTERVAL_FALLBACK[0]}) as lo,
  coalesce(avg(P90), coalesce(sum(weight * P50) / nullif(sum(weight), 0), avg(P50)) * {C.INTERVAL_FALLBACK[1]}) as hi
  from preds p left join shares s on p.model = s.model where P50 is not null group by p.plant_name, p.timestamp),
resid as (select plant_name, list(y_true - P50 order by y_true - P50) as r, count(*) as n from one_step where split = 'val' and y_true - P50 is not null group by plant_name),
all_preds as (select model, plant_name, timestamp, y_true, P10, P50, P90 from preds
  union all select 'Lag_Linear', o.plant_name, timestamp, y_true, P50 + r[cast(greatest(floor((n + 1) * 0.1::double), 1) as bigint)], P50,
    P50 + r[cast(least(ceil((n + 1) * 0.9::double), n) as bigint)] from one_step o left join resid q on o.plant_name = q.plant_name where split = 'test'
  union all select 'Ensemble', plant_name, timestamp, y_true, least(lo, P50, hi), lo + P50 + hi - least(lo, P50, hi) - greatest(lo, P50, hi), greatest(lo, P50, hi) from blend0),
wide_all as ({METRICS_WIDE.replace("from preds", "from all_preds")}),
long_all as (select model, metric, value from (select * from wide_all) unpivot (value for metric in ({", ".join(E.POINT + E.PROB)})) where
  metric in ({", ".join(f"'{m}'" for m in E.POINT)}) or model in ('QuantileBins', 'Lag_Linear', 'Ensemble'))""")


def _all(body: str, doubles) -> str:
    return O.wrap(O.with_adapter(body, _COMPARED), list(doubles))


_PIV = ", ".join(f"max(case when metric = '{m}' then value end) as {m}" for m in E.POINT + E.PROB)


@register("metrics_comparison", _all(f"select model, {_PIV} from long_all group by model", E.POINT + E.PROB))
def q_metrics_comparison(spark, sf):
    """Baselines, bins, the plants' own models and the ensemble in one model x metric table."""
    return E.compare_models(E.evaluate_model(compared(spark, sf)))


_REPORT = """with_best as (select metric, arg_min(model, struct_pack(k := case when metric = 'picp_80' then -value else value end, m := model)) as model,
  arg_min(value, struct_pack(k := case when metric = 'picp_80' then -value else value end, m := model)) as value from long_all where value is not null group by metric),
widest as (select metric, arg_min(model, struct_pack(k := case when metric like 'pinball%' then value else -value end, m := model)) as model,
  arg_min(value, struct_pack(k := case when metric like 'pinball%' then value else -value end, m := model)) as value
  from long_all where value is not null and metric in ('picp_80', 'mpiw_80', 'pinball_avg') group by metric),
lines as (select 'comparison' as section, metric as item, model, value from long_all where value is not null
  union all select 'best', metric, model, value from with_best
  union all select 'probabilistic', metric, model, value from widest
  union all select 'recommendation', case metric when 'mae' then 'best_overall' else 'best_probabilistic' end, model, value from with_best where metric in ('mae', 'pinball_avg')
  union all select 'recommendation', 'reliable', model, value from long_all where metric = 'picp_80' and value >= {min_picp})"""


@register("evaluation_report", O.wrap(O.with_adapter("select section, item, model, value from lines", _COMPARED + ",\n" + _REPORT.format(min_picp=C.RELIABLE_PICP)), ["value"]))
def q_evaluation_report(spark, sf):
    """The evaluation report (comparison, best models, interval analysis, recommendations), written as JSON lines and read back."""
    report = E.evaluation_report(E.evaluate_model(compared(spark, sf)))
    path = stage_path(spark, "evaluation")
    write_report(report, path)
    return spark.read.schema(report.schema).json(path)


@register("metrics_comparison_trained")
def q_metrics_comparison_trained(spark, sf):
    """The comparison with the boosted trees and the pinball-loss models too (both are trained, so there is no SQL twin)."""
    from wattline.plans.q_misc import q_forecast_quantile_conformal
    trees = q_forecast_quantile_conformal(spark, sf).withColumn("model", F.lit("GBT_Conformal"))
    lines = quantile_forecasts(spark, sf).withColumn("model", F.lit("Quantile_Linear"))
    return E.compare_models(E.evaluate_model(compared(spark, sf).unionByName(trees.select(*COLS)).unionByName(lines.select(*COLS))))


# --- all fitted state in one artefact ----------------------------------------------
_STATE = _PLANT + f""",
scaled as (select {', '.join(f'avg({c}) as m{i}, stddev_pop({c}) as s{i}' for i, c in enumerate(FEATURES))} from train)"""


@register("model_artifact", O.wrap(O.with_adapter(
    f"select event_id, f.plant_name, cast(coalesce(e.label, -1) as integer) as plant_code, {O.linear_sql(FEATURES, 'm')} as P50, "
    + ", ".join(f"(f.{c} - m{i}) / (case when s{i} = 0 or s{i} is null then 1.0 else s{i} end) as scaled_{c}" for i, c in enumerate(FEATURES))
    + " from frame f left join fitted m on f.plant_name = m.plant_name cross join (select * from scaled) z "
      "left join (select plant_name, row_number() over (order by plant_name) - 1 as label from (select distinct plant_name from train)) e "
      "on f.plant_name = e.plant_name where split = 'test'", _STATE), ["P50", *[f"scaled_{c}" for c in FEATURES]]))
def q_model_artifact(spark, sf):
    """Encoder, scaler and weights fitted on the train rows, saved in one
    artefact with their metadata, loaded back and applied to the test rows."""
    d = _plant_frame(spark, sf)
    train = d.filter(F.col("split") == "train")
    path = stage_path(spark, "artifact")
    save_model(path, {"encoder": P.label_encoder_fit(train, "plant_name"), "scaler": P.scaler_fit(train, FEATURES),
                      "weights": L.fit_linear(train, KEY, "y_true", FEATURES)},
               meta={"kind": "linear", "keys": KEY, "features": FEATURES})
    tables, _, meta = load_model(spark, path)
    out = score(d.filter(F.col("split") == "test"), tables, meta)
    out = P.label_encode(out, tables["encoder"], "plant_name", "plant_code")
    copies = out.withColumns({f"scaled_{c}": F.col(c).cast("double") for c in meta["features"]})
    stats = tables["scaler"].withColumn("feature", F.concat(F.lit("scaled_"), "feature"))
    scaled = P.scaler_transform(copies, stats, [f"scaled_{c}" for c in meta["features"]])
    return scaled.select("event_id", "plant_name", "plant_code", "P50", *[f"scaled_{c}" for c in meta["features"]])


# --- streamed scores ------------------------------------------------------------------
@register("stream_scores", O.wrap(O.with_adapter("select plant_name, timestamp, y_true, P10, P50, P90 from preds where model = 'QuantileBins'", SERIES),
                                  ["y_true", "P10", "P50", "P90"]))
def q_stream_scores(spark, sf):
    """The test slice as a stream of files, scored by the saved bins; every
    batch is delivered twice, which must not show."""
    s = materialize(series(spark, sf))
    model, source, out = (stage_path(spark, n) for n in ("model", "arrivals", "scores"))
    bins = FC.fit_quantile_bins(FC.add_month_hour(s.filter(F.col("split") != "test")))
    save_model(model, {"bins": bins}, meta={"kind": "bins", "keys": ["plant_name", "month", "hour"]})
    s.filter(F.col("split") == "test").select("plant_name", "timestamp", "y_true").repartition(4).write.parquet(source)
    write = batch_writer(model, out)

    def twice(rows, batch_id):
        write(rows, batch_id)
        write(rows, batch_id)

    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 2).parquet(source)
    query = stream.writeStream.foreachBatch(twice).option("checkpointLocation", stage_path(spark, "progress")).trigger(availableNow=True).start()
    query.awaitTermination()
    return read_scores(spark, out).select("plant_name", "timestamp", "y_true", "P10", "P50", "P90")


# --- late readings ----------------------------------------------------------------------
_WHOLE_SQL, _WHOLE_D = O.pipeline_sql()


@register("refresh_features", O.wrap(_WHOLE_SQL, _WHOLE_D))
def q_refresh_features(spark, sf):
    """The feature table written without a fifth of two plants' readings, then
    brought up to date by them: equal to one built at once."""
    gen, wea = tables(spark, sf)
    late = gen.filter(F.col("plant_name").isin("solar_a", "wind_b") & (F.col("event_id") % 5 == 0))
    path = stage_path(spark, "features")
    write_features(pipeline_features(gen.join(late.select("event_id"), "event_id", "left_anti"), wea, tiebreak=("event_id",)), path)
    refresh_features(path, gen, wea, late, tiebreak=("event_id",))
    return spark.read.parquet(path).drop(MONTH)

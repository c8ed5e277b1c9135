"""Registered queries: sources, joins, repair, alignment, features, pipeline."""

from __future__ import annotations


from pyspark.sql import functions as F

from wattline import config as C
from wattline.functions import physics as P
from wattline.functions.calendar import calendar_columns, cyclical_columns
from wattline.operators import features as FE
from wattline.operators.align import resample_hourly
from wattline.operators.joins import (aggregate_weather_by_time, join_equi_time, join_site_weather, join_spine,
                                      merge_weather)
from wattline.operators.repair import bfill_limited, ffill_limited, interpolate, repair_missing
from wattline.plans import oracle as O
from wattline.plans.pipeline import pipeline_features
from wattline.plans.registry import register, tables
from wattline.sources.adapter import adapter_plants
from wattline.schema import GENERATION_SCHEMA, weather_schema
from wattline.session import stage_path
from wattline.sources.readers import normalize_time_key, read_generation, read_weather

W = list(C.WEATHER_COLS)
KW = list(C.KEY_WEATHER_COLS)
GEN_D = ["capacity_mw", "generation_mw", "latitude", "longitude"]
TB = ("event_id",)

# --- shared oracle fragments -------------------------------------------------
GEN_HOURLY = """gen_hourly as (select plant_name, date_trunc('hour', timestamp) as timestamp,
  avg(generation_mw) as generation_mw,
  arg_min(capacity_mw, timestamp) filter (where capacity_mw is not null) as capacity_mw,
  arg_min(plant_type, timestamp) filter (where plant_type is not null) as plant_type
  from generation group by plant_name, date_trunc('hour', timestamp))"""
GEN_GRID = GEN_HOURLY + """,
gb as (select plant_name, min(timestamp) lo, max(timestamp) hi from gen_hourly group by plant_name),
gen_grid as (select s.plant_name, s.timestamp, h.generation_mw, h.capacity_mw, h.plant_type
  from (select plant_name, unnest(generate_series(lo, hi, interval 1 hour)) as timestamp from gb) s
  left join gen_hourly h on s.plant_name = h.plant_name and s.timestamp = h.timestamp)"""
SITE_HOURLY = f"""site_hourly as (select location, timestamp, {', '.join(f'avg({c}) as {c}' for c in W)}
  from weather group by location, timestamp),
sb as (select location, min(timestamp) lo, max(timestamp) hi from site_hourly group by location),
site_grid as (select s.location, s.timestamp, {', '.join('h.' + c for c in W)}
  from (select location, unnest(generate_series(lo, hi, interval 1 hour)) as timestamp from sb) s
  left join site_hourly h on s.location = h.location and s.timestamp = h.timestamp)"""


def _gen_grid(spark, sf):
    gen, _ = tables(spark, sf)
    hourly = resample_hourly(gen, mean_cols=["generation_mw"], first_cols=["capacity_mw", "plant_type"], tiebreak=TB)
    return join_spine(hourly)


def _site_grid(spark, sf):
    _, wea = tables(spark, sf)
    hourly = wea.groupBy("location", "timestamp").agg(*[F.avg(c).alias(c) for c in W])
    return join_spine(hourly, keys=("location",))


# --- flagship ----------------------------------------------------------------
_PIPE_SQL, _PIPE_D = O.pipeline_sql()


@register("pipeline_features", O.wrap(_PIPE_SQL, _PIPE_D))
def q_pipeline_features(spark, sf):
    """Full chain: merge -> repair -> align -> calendar/lags/rolling/domain -> clip."""
    gen, wea = tables(spark, sf)
    return pipeline_features(gen, wea, tiebreak=TB)


# --- sources -------------------------------------------------------------------
@register("scan_generation", O.wrap(O.with_adapter("select * from generation"), GEN_D))
def q_scan_generation(spark, sf):
    gen, _ = tables(spark, sf)
    return gen


_GCSV = ("select timestamp, plant_name, plant_type, capacity_mw, generation_mw, generation_mw / capacity_mw as capacity_factor, "
         "latitude, longitude from generation")
_CSV_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _through_csv(spark, df, read):
    """``df`` written as CSV to the shared folder and read by ``read(path)``."""
    path = stage_path(spark, "csv")
    df.write.option("header", True).option("timestampNTZFormat", _CSV_TIME).csv(path)
    return read(path)


@register("scan_generation_csv", O.wrap(O.with_adapter(_GCSV), [c for c in GEN_D if c != "event_id"] + ["capacity_factor"]))
def q_scan_generation_csv(spark, sf):
    """The generation facts as CSV files, read with the fixed schema."""
    gen, _ = tables(spark, sf)
    cols = [f.name for f in GENERATION_SCHEMA.fields]
    flat = gen.withColumn("capacity_factor", F.col("generation_mw") / F.col("capacity_mw")).select(*cols)
    return _through_csv(spark, flat, lambda p: read_generation(spark, p, fmt="csv"))


@register("scan_weather_csv", O.wrap(O.with_adapter("select timestamp, location, " + ", ".join(W) + " from weather"), W))
def q_scan_weather_csv(spark, sf):
    """The weather facts as CSV files keyed by ``time``, read with the fixed schema."""
    _, wea = tables(spark, sf)
    fields = weather_schema("time").fieldNames()
    flat = wea.withColumnRenamed("timestamp", "time")
    flat = flat.select(*[F.col(c) if c in flat.columns else F.lit(None).cast("string").alias(c) for c in fields])
    back = _through_csv(spark, flat, lambda p: read_weather(spark, p, fmt="csv", time_key="time"))
    return back.select("timestamp", "location", *W)


_WEATHER_D = W


@register("scan_weather", O.wrap(O.with_adapter("select * from weather"), _WEATHER_D))
def q_scan_weather(spark, sf):
    """Weather with its time key normalised (``time``/``date`` -> ``timestamp``)."""
    _, wea = tables(spark, sf)
    return normalize_time_key(wea.withColumnRenamed("timestamp", "time"))


# --- joins ---------------------------------------------------------------------
@register("agg_weather_time", O.wrap(O.with_adapter("select * from wagg", O.merged_ctes()), W))
def q_agg_weather_time(spark, sf):
    _, wea = tables(spark, sf)
    return aggregate_weather_by_time(wea, W)


@register("join_asof_nearest", O.wrap(O.with_adapter("select * from merged", O.merged_ctes()), GEN_D + W))
def q_join_asof_nearest(spark, sf):
    gen, wea = tables(spark, sf)
    return merge_weather(gen, wea, W)


_EQUI = O.with_adapter(
    "select h.plant_name, h.timestamp, h.generation_mw, w.temperature_2m, w.wind_speed, "
    "w.surface_solar_radiation_downwards from gen_hourly h join wagg w on h.timestamp = w.timestamp",
    GEN_HOURLY + ",\n" + O.merged_ctes())


@register("join_equi_time", O.wrap(_EQUI, ["generation_mw"] + KW))
def q_join_equi_time(spark, sf):
    gen, wea = tables(spark, sf)
    hourly = resample_hourly(gen, mean_cols=["generation_mw"], first_cols=(), tiebreak=TB)
    wagg = aggregate_weather_by_time(wea, KW)
    return join_equi_time(hourly, wagg).select("plant_name", "timestamp", "generation_mw", *KW)


_SITE = O.with_adapter(
    "select w.location, w.timestamp, p.plant_name, p.capacity_mw, w.wind_speed, w.temperature_2m "
    "from weather w join plant p on w.location = p.location")


@register("join_cross_plants", O.wrap(_SITE, ["capacity_mw", "wind_speed", "temperature_2m"]))
def q_join_cross_plants(spark, sf):
    """Each plant gets the weather series of its site (keyed, not a cross join)."""
    _, wea = tables(spark, sf)
    plants = adapter_plants(spark).select("location", "plant_name", "capacity_mw")
    return join_site_weather(wea.select("location", "timestamp", "wind_speed", "temperature_2m"), plants) \
        .select("location", "timestamp", "plant_name", "capacity_mw", "wind_speed", "temperature_2m")


@register("join_spine", O.wrap(O.with_adapter("select * from gen_grid", GEN_GRID), ["generation_mw", "capacity_mw"]))
def q_join_spine(spark, sf):
    return _gen_grid(spark, sf)


@register("resample_hourly", O.wrap(O.with_adapter("select * from gen_hourly", GEN_HOURLY), ["generation_mw", "capacity_mw"]))
def q_resample_hourly(spark, sf):
    gen, _ = tables(spark, sf)
    return resample_hourly(gen, mean_cols=["generation_mw"], first_cols=["capacity_mw", "plant_type"], tiebreak=TB)


_GROUP_MAP = O.with_adapter(
    "select plant_name, timestamp, generation_mw, avg(generation_mw) over (partition by plant_name, hour(timestamp)) "
    "as clim_mw from generation")


@register("join_group_map", O.wrap(_GROUP_MAP, ["generation_mw", "clim_mw"]))
def q_join_group_map(spark, sf):
    """Per (plant, hour-of-day) mean attached to each row."""
    from wattline.operators.joins import attach_group_mean
    gen, _ = tables(spark, sf)
    g = gen.select("plant_name", "timestamp", "generation_mw").withColumn("_h", F.hour("timestamp"))
    return attach_group_mean(g, "generation_mw", ["plant_name", "_h"], "clim_mw").drop("_h")


# --- repair --------------------------------------------------------------------
@register("repair_missing", O.wrap(O.with_adapter("select * from repaired", O.merged_ctes() + ",\n" + O.repaired_ctes()), GEN_D + W))
def q_repair_missing(spark, sf):
    gen, wea = tables(spark, sf)
    return repair_missing(merge_weather(gen, wea, W), W, tiebreak=TB)


def _interp_grid_sql(expr_fn, cols=("generation_mw",), src="gen_grid", part="plant_name", extra=""):
    pn = O._prev_next(list(cols), part, "timestamp")
    body = ", ".join(f"{expr_fn(c)} as {c}" for c in cols)
    keep = ", ".join(x for x in [part, "timestamp", extra] if x)
    return (f"select {keep}, {body} from (select *, {pn} from "
            f"(select *, row_number() over (partition by {part} order by timestamp) as rn from {src}))")


_INTERP_T = O.with_adapter(_interp_grid_sql(lambda c: O.interp_sql(c, C.MAX_GAP_ROWS, "time")), GEN_GRID)


@register("interpolate_time", O.wrap(_INTERP_T, ["generation_mw"]))
def q_interpolate_time(spark, sf):
    g = _gen_grid(spark, sf).select("plant_name", "timestamp", "generation_mw")
    return interpolate(g, ["generation_mw"], limit=C.MAX_GAP_ROWS, method="time")


_INTERP_L = O.with_adapter(
    "select plant_name, timestamp, event_id, "
    f"{O.interp_sql('generation_mw', C.MAX_GAP_ROWS, 'linear')} as generation_mw from (select *, "
    f"{O._prev_next(['generation_mw'], 'plant_name', 'timestamp, event_id')} from (select *, row_number() over "
    "(partition by plant_name order by timestamp, event_id) as rn from generation))")


@register("interpolate_linear", O.wrap(_INTERP_L, ["generation_mw"]))
def q_interpolate_linear(spark, sf):
    gen, _ = tables(spark, sf)
    g = gen.select("plant_name", "timestamp", "event_id", "generation_mw")
    return interpolate(g, ["generation_mw"], limit=C.MAX_GAP_ROWS, method="linear", tiebreak=TB)


_FF = O.with_adapter(_interp_grid_sql(lambda c: O.fill_sql(c, C.FILL_LIMIT_ROWS, None), W, "site_grid", "location"), SITE_HOURLY)
_BF = O.with_adapter(_interp_grid_sql(lambda c: O.fill_sql(c, None, C.FILL_LIMIT_ROWS), W, "site_grid", "location"), SITE_HOURLY)


@register("ffill_limited", O.wrap(_FF, W))
def q_ffill_limited(spark, sf):
    return ffill_limited(_site_grid(spark, sf), W, keys=("location",))


@register("bfill_limited", O.wrap(_BF, W))
def q_bfill_limited(spark, sf):
    return bfill_limited(_site_grid(spark, sf), W, keys=("location",))


_TD = O.with_adapter(
    "select plant_name, timestamp, event_id, cast(epoch_us(timestamp) - epoch_us(lag(timestamp) over "
    "(partition by plant_name order by timestamp, event_id)) as double) / 1e6 as dt_seconds from generation")


@register("time_diff", O.wrap(_TD, ["dt_seconds"]))
def q_time_diff(spark, sf):
    """Seconds since the previous row of the same plant (halo-free: uses carry)."""
    from wattline.operators.series import time_diff
    gen, _ = tables(spark, sf)
    return time_diff(gen.select("plant_name", "timestamp", "event_id"), tiebreak=TB)


# --- features ------------------------------------------------------------------
def _lag_sql(cols, part, src):
    w = f"partition by {part} order by timestamp"
    lag = ", ".join(f"lag({c}, {n}) over ({w}) as {c}_lag_{n}h" for n in C.LAGS for c in cols)
    return f"select {part}, timestamp, {', '.join(cols)}, {lag} from {src}", [
        f"{c}_lag_{n}h" for n in C.LAGS for c in cols] + list(cols)


def _roll_sql(col_stats, part, src):
    w = f"partition by {part} order by timestamp"
    fn = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    sel, names = [], []
    for c, stats in col_stats.items():
        for n in C.ROLLING_WINDOWS:
            for s in stats:
                sel.append(f"{fn[s]}({c}) over ({w} rows between {n - 1} preceding and current row) as {c}_roll_{s}_{n}h")
                names.append(f"{c}_roll_{s}_{n}h")
    return f"select {part}, timestamp, {', '.join(col_stats)}, {', '.join(sel)} from {src}", names + list(col_stats)


_LT, _LT_D = _lag_sql(["generation_mw"], "plant_name", "gen_grid")
_LW, _LW_D = _lag_sql(KW, "location", "site_grid")
_RT, _RT_D = _roll_sql({"generation_mw": ("mean", "std", "min", "max")}, "plant_name", "gen_grid")
_RW, _RW_D = _roll_sql({c: ("mean",) for c in KW}, "location", "site_grid")


@register("lag_target", O.wrap(O.with_adapter(_LT, GEN_GRID), _LT_D))
def q_lag_target(spark, sf):
    g = _gen_grid(spark, sf).select("plant_name", "timestamp", "generation_mw")
    return FE.add_lag_features(g, ["generation_mw"])


@register("lag_weather", O.wrap(O.with_adapter(_LW, SITE_HOURLY), _LW_D))
def q_lag_weather(spark, sf):
    g = _site_grid(spark, sf).select("location", "timestamp", *KW)
    return FE.add_lag_features(g, KW, keys=("location",))


@register("rolling_target", O.wrap(O.with_adapter(_RT, GEN_GRID), _RT_D))
def q_rolling_target(spark, sf):
    g = _gen_grid(spark, sf).select("plant_name", "timestamp", "generation_mw")
    return FE.add_rolling_features(g, {"generation_mw": ("mean", "std", "min", "max")})


@register("rolling_weather", O.wrap(O.with_adapter(_RW, SITE_HOURLY), _RW_D))
def q_rolling_weather(spark, sf):
    g = _site_grid(spark, sf).select("location", "timestamp", *KW)
    return FE.add_rolling_features(g, {c: ("mean",) for c in KW}, keys=("location",))


_CAL = O.with_adapter(f"select event_id, timestamp, {O.calendar_sql()} from generation")
_CYC = O.with_adapter(f"select event_id, {O.cyclical_sql()} from (select event_id, {O.calendar_sql()} from generation)")


@register("calendar_features", _CAL)
def q_calendar_features(spark, sf):
    gen, _ = tables(spark, sf)
    return gen.select("event_id", "timestamp", *[c.alias(n) for n, c in calendar_columns("timestamp").items()])


@register("cyclical_features", O.wrap(_CYC, ["hour_sin", "hour_cos", "month_sin", "month_cos", "dayofyear_sin", "dayofyear_cos"]))
def q_cyclical_features(spark, sf):
    gen, _ = tables(spark, sf)
    cal = gen.select("event_id", *[c.alias(n) for n, c in calendar_columns("timestamp").items()])
    return cal.select("event_id", *[c.alias(n) for n, c in cyclical_columns().items()])


# Domain features over generation rows joined to their nearest weather.
_DOM_BASE = ("select event_id, plant_type, generation_mw, capacity_mw, temperature_2m, wind_speed, "
             "surface_pressure, surface_solar_radiation_downwards, "
             "cast(hour(timestamp) as integer) as hour, cast(dayofyear(timestamp) as integer) as day_of_year from merged")


def _dom(spark, sf):
    gen, wea = tables(spark, sf)
    m = merge_weather(gen, wea, W)
    return m.select("event_id", "plant_type", "generation_mw", "capacity_mw", "temperature_2m", "wind_speed",
                    "surface_pressure", "surface_solar_radiation_downwards",
                    F.hour("timestamp").cast("int").alias("hour"), F.dayofyear("timestamp").cast("int").alias("day_of_year"))


def _dom_sql(expr: str, name: str) -> str:
    return O.wrap(O.with_adapter(f"select event_id, {expr} as {name} from ({_DOM_BASE})", O.merged_ctes()), [name])


def _dq(name):
    return O.domain_exprs()[name]


@register("clear_sky_index", _dom_sql(_dq("clear_sky_index"), "clear_sky_index"))
def q_clear_sky_index(spark, sf):
    return _dom(spark, sf).select("event_id", P.clear_sky_index().alias("clear_sky_index"))


@register("irradiance_temp_adjusted", _dom_sql(_dq("irradiance_temp_adjusted"), "irradiance_temp_adjusted"))
def q_irradiance_temp_adjusted(spark, sf):
    return _dom(spark, sf).select("event_id", P.irradiance_temp_adjusted().alias("irradiance_temp_adjusted"))


@register("wind_power_density", _dom_sql(_dq("wind_power_density"), "wind_power_density"))
def q_wind_power_density(spark, sf):
    return _dom(spark, sf).select("event_id", P.wind_power_density().alias("wind_power_density"))


@register("wind_speed_category", O.wrap(O.with_adapter(
    f"select event_id, wind_speed, case when plant_type = 'wind' then {O.wind_category_sql()} end as wind_speed_category "
    f"from ({_DOM_BASE})", O.merged_ctes()), ["wind_speed"]))
def q_wind_speed_category(spark, sf):
    return _dom(spark, sf).select("event_id", "wind_speed", P.wind_speed_category().alias("wind_speed_category"))


@register("capacity_factor", O.wrap(O.with_adapter(
    "select event_id, generation_mw / nullif(capacity_mw, 0) as capacity_factor from generation"), ["capacity_factor"]))
def q_capacity_factor(spark, sf):
    gen, _ = tables(spark, sf)
    return gen.select("event_id", P.capacity_factor().alias("capacity_factor"))


@register("clip_physical", O.wrap(O.with_adapter(
    f"select event_id, {O.clip_generation_sql()} as generation_mw, "
    f"{O.clip_sql('temperature_2m', '-10.0', '60.0')} as temperature_2m, "
    f"{O.clip_sql('wind_speed', '0.0', '50.0')} as wind_speed, "
    f"{O.clip_sql('surface_solar_radiation_downwards', '0.0', '1500.0')} as surface_solar_radiation_downwards "
    f"from merged", O.merged_ctes()), ["generation_mw", "temperature_2m", "wind_speed", "surface_solar_radiation_downwards"]))
def q_clip_physical(spark, sf):
    gen, wea = tables(spark, sf)
    m = merge_weather(gen, wea, W)
    return FE.clip_physical(m).select("event_id", "generation_mw", *[c for c in C.CLIP_RANGES])

"""Registered queries: filters, scalar functions, reports, preprocessing,
ensembles, serving, trees, sources/sinks round trips."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from wattline import config as C
from wattline.functions import forecast as FF
from wattline.functions import physics as P
from wattline.functions.calendar import calendar_columns
from wattline.operators import features as FE
from wattline.operators import filters as FL
from wattline.operators import forecasting as FC
from wattline.operators import preprocess as PP
from wattline.operators import reports as R
from wattline.operators.evaluation import compare_models, evaluate_model
from wattline.operators.joins import merge_weather
from wattline.operators.repair import drop_critical_nulls
from wattline.operators.series import multi_horizon_frame
from wattline.plans import oracle as O
from wattline.plans.q_core import GEN_GRID, _gen_grid
from wattline.plans.q_eval import METRICS_WIDE, SERIES, SERIES_VAL, predictions, series
from wattline.plans.registry import register, tables
from wattline.sources.adapter import ADAPTER_PLANTS, adapter_plants, load_table
from wattline.sources.readers import flatten_service_payload, read_features, tidy_grid
from wattline.sources.sinks import write_partitioned

W = list(C.WEATHER_COLS)
GEN_D = ["capacity_mw", "generation_mw", "latitude", "longitude"]
GEN_COLS = ["timestamp", "event_id", "plant_name", "plant_type", "capacity_mw", "generation_mw", "latitude", "longitude"]
TB = ("event_id",)


def _gen(spark, sf):
    return tables(spark, sf)[0]


def _merged(spark, sf):
    gen, wea = tables(spark, sf)
    return merge_weather(gen, wea, W)


def _a(body, doubles=(), extra=""):
    return O.wrap(O.with_adapter(body, extra), list(doubles))


def _m(body, doubles=()):
    return O.wrap(O.with_adapter(body, O.merged_ctes()), list(doubles))


# --- filters / projections -----------------------------------------------------
@register("filter_plants", _a("select * from generation where plant_name in ('solar_a', 'wind_b')", GEN_D))
def q_filter_plants(spark, sf):
    return FL.filter_plants(_gen(spark, sf), ["solar_a", "wind_b"])


@register("filter_plant_eq", _a("select * from generation where plant_name = 'wind_a'", GEN_D))
def q_filter_plant_eq(spark, sf):
    return FL.filter_plant_eq(_gen(spark, sf), "wind_a")


_BB = C.BBOX


@register("filter_bbox", _a(f"select * from generation where latitude between {_BB['south']} and {_BB['north']} "
                            f"and longitude between {_BB['west']} and {_BB['east']}", GEN_D))
def q_filter_bbox(spark, sf):
    return FL.filter_bbox(_gen(spark, sf))


@register("filter_date_range", _a("select * from generation where timestamp >= timestamp '2024-01-10 00:00:00' "
                                  "and timestamp < timestamp '2024-01-21 00:00:00'", GEN_D))
def q_filter_date_range(spark, sf):
    return FL.filter_date_range(_gen(spark, sf), "2024-01-10", "2024-01-20")


@register("drop_critical_nulls", _a("select * from generation where generation_mw is not null and plant_name is not null "
                                    "and timestamp is not null", GEN_D))
def q_drop_critical_nulls(spark, sf):
    return drop_critical_nulls(_gen(spark, sf))


@register("mask_type", _m("select event_id, case when plant_type = 'solar' then surface_solar_radiation_downwards end "
                          "as solar_irradiance, case when plant_type = 'wind' then wind_speed end as wind_only_speed from merged",
                          ["solar_irradiance", "wind_only_speed"]))
def q_mask_type(spark, sf):
    m = _merged(spark, sf)
    return m.select("event_id", FL.mask_type(F.col("surface_solar_radiation_downwards"), "solar").alias("solar_irradiance"),
                    FL.mask_type(F.col("wind_speed"), "wind").alias("wind_only_speed"))


@register("filter_daylight", _m("select event_id, plant_name, timestamp, generation_mw, surface_solar_radiation_downwards "
                                "from merged where plant_type = 'solar' and hour(timestamp) between 6 and 18",
                                ["generation_mw", "surface_solar_radiation_downwards"]))
def q_filter_daylight(spark, sf):
    return FL.filter_daylight(_merged(spark, sf)).select(
        "event_id", "plant_name", "timestamp", "generation_mw", "surface_solar_radiation_downwards")


# A reanalysis-style grid derived from the view events (short names, Kelvin).
K = "cast(json_extract_string(props, '$.k') as double)"
_GRID_SQL = f"""grid as (select date_trunc('hour', ts) as time, event_id,
  12.0 + (user_id % 7) * 0.25 as latitude, 75.0 + (user_id % 5) * 0.25 as longitude,
  293.15 + {K} * 0.1 as t2m, 288.15 + {K} * 0.05 as d2m, 95000.0 + {K} * 50.0 as sp, value / 1000.0 as tp,
  value * 6.0 as ssrd, {K} as tcc, value / 10.0 - 2.0 as u10, {K} / 10.0 - 5.0 as v10
  from events where event_type = 'view')"""


def _grid(spark, sf):
    ev = load_table(spark, sf, "events").filter(F.col("event_type") == "view")
    k = F.get_json_object("props", "$.k").cast("double")
    return ev.select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time"), "event_id",
        (F.lit(12.0) + (F.col("user_id") % 7) * F.lit(0.25)).alias("latitude"),
        (F.lit(75.0) + (F.col("user_id") % 5) * F.lit(0.25)).alias("longitude"),
        (F.lit(293.15) + k * F.lit(0.1)).alias("t2m"), (F.lit(288.15) + k * F.lit(0.05)).alias("d2m"),
        (F.lit(95000.0) + k * F.lit(50.0)).alias("sp"), (F.col("value") / F.lit(1000.0)).alias("tp"),
        (F.col("value") * F.lit(6.0)).alias("ssrd"), k.alias("tcc"),
        (F.col("value") / F.lit(10.0) - F.lit(2.0)).alias("u10"), (k / F.lit(10.0) - F.lit(5.0)).alias("v10"))


_REN = ", ".join(f"{s} as {l}" for s, l in C.GRID_RENAMES.items())
_REN_D = ["latitude", "longitude", *C.GRID_RENAMES.values()]


@register("rename_columns", _a(f"select time, event_id, latitude, longitude, {_REN} from grid", _REN_D, _GRID_SQL))
def q_rename_columns(spark, sf):
    return FL.rename_columns(_grid(spark, sf))


@register("add_location_literal", _a("select * replace ('site_north' as location), 50.5 as latitude, 9.25 as longitude from weather",
                                     W + ["latitude", "longitude"]))
def q_add_location_literal(spark, sf):
    _, wea = tables(spark, sf)
    return FL.add_location_literal(wea, "site_north", 50.5, 9.25)


_TIDY_D = ["latitude", "longitude", "wind_speed", "wind_direction", *C.GRID_RENAMES.values()]
_TIDY = _a(f"select time, event_id, latitude, longitude, sqrt(u10 * u10 + v10 * v10) as wind_speed, "
           f"atan2(v10, u10) * 180.0 / {math.pi} as wind_direction, "
           f"t2m - {C.KELVIN} as temperature_2m, d2m - {C.KELVIN} as dewpoint_2m, sp as surface_pressure, "
           f"tp as total_precipitation, ssrd as surface_solar_radiation_downwards, tcc as total_cloud_cover, "
           f"u10 as wind_u_component, v10 as wind_v_component, 'grid' as location from grid", _TIDY_D, _GRID_SQL)


@register("weather_grid_tidy", _TIDY)
def q_weather_grid_tidy(spark, sf):
    return tidy_grid(_grid(spark, sf), "grid")


@register("wind_vector", _a("select event_id, sqrt(u10 * u10 + v10 * v10) as wind_speed, "
                            f"atan2(v10, u10) * 180.0 / {math.pi} as wind_direction from grid",
                            ["wind_speed", "wind_direction"], _GRID_SQL))
def q_wind_vector(spark, sf):
    s, d = P.wind_vector("u10", "v10")
    return _grid(spark, sf).select("event_id", s.alias("wind_speed"), d.alias("wind_direction"))


@register("kelvin_to_celsius", _a(f"select event_id, t2m - {C.KELVIN} as temperature_2m, d2m - {C.KELVIN} as dewpoint_2m from grid",
                                  ["temperature_2m", "dewpoint_2m"], _GRID_SQL))
def q_kelvin_to_celsius(spark, sf):
    g = _grid(spark, sf)
    return g.select("event_id", P.kelvin_to_celsius("t2m").alias("temperature_2m"), P.kelvin_to_celsius("d2m").alias("dewpoint_2m"))


# --- weather-service payload (built per site and day from events) --------------
# FIXED VALUES: event type -> service parameter used by the test payloads
EVENT_PARAM = {"click": "T2M", "error": "RH2M", "purchase": "WS2M", "signup": "ALLSKY_SFC_SW_DWN", "view": "PS"}


def _payloads(spark, sf):
    ev = load_table(spark, sf, "events")
    pmap = F.create_map(*[x for kv in EVENT_PARAM.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    cells = ev.groupBy(F.concat(F.lit("site_"), (F.col("user_id") % 4).cast("string")).alias("location"),
                       F.date_format("ts", "yyyyMMdd").alias("day"), pmap[F.col("event_type")].alias("param")) \
        .agg(F.avg("value").alias("v"))
    per_param = cells.select("location", "day", "param", F.map_from_arrays(F.array("day"), F.array("v")).alias("series"))
    doc = per_param.groupBy("location", "day").agg(F.map_from_entries(F.collect_list(F.struct("param", "series"))).alias("p"))
    return doc.select("location", F.to_json(F.struct(F.struct(F.col("p").alias("parameter")).alias("properties"))).alias("payload"))


_PAY = ", ".join(
    f"avg(value) filter (where event_type = '{e}') as {p}" for e, p in EVENT_PARAM.items())
_PAY_NULL = ", ".join(f"cast(null as double) as {p}" for p in C.SERVICE_PARAMETERS if p not in EVENT_PARAM.values())
_FLAT = (f"select location, date, {', '.join(C.SERVICE_PARAMETERS)} from (select 'site_' || cast(user_id % 4 as varchar) as location, "
         f"cast(ts as date) as date, {_PAY}, {_PAY_NULL} from events group by all)")


@register("weather_json_flatten", O.wrap(_FLAT, list(C.SERVICE_PARAMETERS)))
def q_weather_json_flatten(spark, sf):
    """Nested parameter -> date -> value payload (one document per site-day,
    built from events) flattened to one row per site and date."""
    return flatten_service_payload(_payloads(spark, sf))


# --- sources / sinks round trips ----------------------------------------------
@register("sink_partitioned", _a("select * from generation", GEN_D))
def q_sink_partitioned(spark, sf):
    """Write per plant type / plant folders to the shared checkpoint folder
    and read the combined table back (partition discovery)."""
    from wattline.session import stage_path
    path = stage_path(spark, "sink")
    write_partitioned(_gen(spark, sf), path)
    return spark.read.parquet(path).select(*GEN_COLS)


_PIPE_SQL, _PIPE_D = O.pipeline_sql("select plant_name, timestamp, generation_mw, generation_mw_lag_24h, "
                                    "generation_mw_roll_mean_24h, capacity_factor from features")


@register("scan_features", O.wrap(_PIPE_SQL, ["generation_mw", "generation_mw_lag_24h", "generation_mw_roll_mean_24h",
                                              "capacity_factor"]))
def q_scan_features(spark, sf):
    """Feature table written (partitioned by plant) and re-read with pruning."""
    from wattline.plans.pipeline import pipeline_features
    from wattline.session import stage_path
    from wattline.sources.sinks import write_features
    gen, wea = tables(spark, sf)
    path = stage_path(spark, "features")
    write_features(pipeline_features(gen, wea, tiebreak=TB), path)
    return read_features(spark, path, ["plant_name", "timestamp", "generation_mw", "generation_mw_lag_24h",
                                       "generation_mw_roll_mean_24h", "capacity_factor"])


# --- requests -------------------------------------------------------------------
_REQ_SQL = f"""requests as (select event_id as request_id,
  case when event_id % 17 = 0 then null else 10 + {K} * 0.5 end as temperature_2m,
  cast(user_id % 30 as double) as wind_speed, value * 6.0 as surface_solar_radiation_downwards,
  {K} as total_cloud_cover, value / 100.0 as total_precipitation,
  cast(user_id % 30 as integer) as hour, cast(event_id % 14 as integer) as month,
  case when user_id % 2 = 0 then 'solar' else 'wind' end as plant_type, 'QuantileBins' as model from events)"""


def _requests(spark, sf):
    ev = load_table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    return ev.select(
        F.col("event_id").alias("request_id"),
        F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("double")).otherwise(F.lit(10.0) + k * F.lit(0.5)).alias("temperature_2m"),
        (F.col("user_id") % 30).cast("double").alias("wind_speed"),
        (F.col("value") * F.lit(6.0)).alias("surface_solar_radiation_downwards"),
        k.alias("total_cloud_cover"), (F.col("value") / F.lit(100.0)).alias("total_precipitation"),
        (F.col("user_id") % 30).cast("int").alias("hour"), (F.col("event_id") % 14).cast("int").alias("month"),
        F.when(F.col("user_id") % 2 == 0, "solar").otherwise("wind").alias("plant_type"),
        F.lit("QuantileBins").alias("model"))


_REQ_D = ["temperature_2m", "wind_speed", "surface_solar_radiation_downwards", "total_cloud_cover", "total_precipitation"]
_REQ_REQUIRED = ["temperature_2m", "wind_speed", "surface_solar_radiation_downwards", "total_cloud_cover",
                 "total_precipitation", "hour", "month", "plant_type"]
_REASON = ("case " + " ".join(f"when {c} is null then 'missing:{c}'" for c in _REQ_REQUIRED)
           + " when not (hour between 0 and 23) then 'hour_out_of_range' when not (month between 1 and 12) "
             "then 'month_out_of_range' end")


@register("request_validate", _a(f"select *, {_REASON} as reason, ({_REASON}) is null as is_valid from requests", _REQ_D, _REQ_SQL))
def q_request_validate(spark, sf):
    return FL.validate_requests(_requests(spark, sf))


@register("default_coalesce", _a("select request_id, coalesce(surface_solar_radiation_downwards, 800.0) as irradiance, "
                                 "coalesce(temperature_2m, 25.0) as temperature, coalesce(total_cloud_cover, 30.0) as cloud_cover, "
                                 "coalesce(wind_speed, 5.0) as wind from requests",
                                 ["irradiance", "temperature", "cloud_cover", "wind"], _REQ_SQL))
def q_default_coalesce(spark, sf):
    r = _requests(spark, sf)
    cols = r.columns
    d = C.WEATHER_DEFAULTS
    return r.select("request_id",
                    P.default_coalesce(cols, ["surface_solar_radiation_downwards", "irradiance"], d["surface_solar_radiation_downwards"]).alias("irradiance"),
                    P.default_coalesce(cols, ["temperature_2m", "temperature"], d["temperature_2m"]).alias("temperature"),
                    P.default_coalesce(cols, ["total_cloud_cover", "cloud_cover"], d["total_cloud_cover"]).alias("cloud_cover"),
                    P.default_coalesce(cols, ["wind_speed", "wind"], d["wind_speed"]).alias("wind"))


# --- physics over merged rows ----------------------------------------------------
_PV = ("case when surface_solar_radiation_downwards is null then null when surface_solar_radiation_downwards <= 0 then 0.0 "
       "else greatest(0.0, least(surface_solar_radiation_downwards * ((100.0 - total_cloud_cover) / 100.0) * 0.22 * "
       "(1.0 - 0.004 * (temperature_2m - 25.0)) / 1000000.0 * 1000.0, capacity_mw)) end")


@register("pv_expected_power", _m(f"select event_id, {_PV} as expected_mw from merged where plant_type = 'solar'", ["expected_mw"]))
def q_pv_expected_power(spark, sf):
    m = _merged(spark, sf).filter(F.col("plant_type") == "solar")
    return m.select("event_id", P.pv_expected_power().alias("expected_mw"))


_WC = ("case when wind_speed is null then null when wind_speed < 3.0 or wind_speed > 25.0 then 0.0 "
       "when wind_speed <= 12.0 then capacity_mw * ((wind_speed * wind_speed * wind_speed - 27.0) / 1701.0) else capacity_mw end")


@register("wind_power_curve", _m(f"select event_id, {_WC} as expected_mw from merged where plant_type = 'wind'", ["expected_mw"]))
def q_wind_power_curve(spark, sf):
    m = _merged(spark, sf).filter(F.col("plant_type") == "wind")
    return m.select("event_id", P.wind_power_curve().alias("expected_mw"))


# --- reports -------------------------------------------------------------------
@register("total_capacity", _a("select sum(c) as total_capacity_mw, count(*) as plants from (select arg_min(capacity_mw, "
                               "(timestamp, event_id)) as c from generation group by plant_name)", ["total_capacity_mw"]))
def q_total_capacity(spark, sf):
    return R.total_capacity(_gen(spark, sf), tiebreak=TB)


@register("cf_by_type", _a("select plant_type, avg(generation_mw / nullif(capacity_mw, 0)) as mean_capacity_factor "
                           "from generation group by plant_type", ["mean_capacity_factor"]))
def q_cf_by_type(spark, sf):
    return R.cf_by_type(_gen(spark, sf))


# lineitem as a multi-year generation stream: supplier -> plant, price -> MW
_LI_SQL = (f"li_gen as (select l_shipdate as timestamp, plant_type, capacity_mw, l_extendedprice / 1000.0 as generation_mw "
           f"from lineitem join plant on l_suppkey % {len(ADAPTER_PLANTS)} = pid)")


def _li_gen(spark, sf):
    li = load_table(spark, sf, "lineitem")
    plants = F.broadcast(adapter_plants(spark))
    j = li.join(plants, (F.col("l_suppkey") % F.lit(len(ADAPTER_PLANTS))) == F.col("pid"))
    return j.select(F.col("l_shipdate").alias("timestamp"), "plant_type", "capacity_mw",
                    (F.col("l_extendedprice") / F.lit(1000.0)).alias("generation_mw"))


_MONTHS = ", ".join(f"{O.round_even_sql(f'avg(generation_mw / nullif(capacity_mw, 0)) filter (where month(timestamp) = {m})', 3)} "
                    f"as m{m:02d}" for m in range(1, 13))


@register("cf_monthly_pivot", _a(f"select plant_type, {_MONTHS} from li_gen group by plant_type",
                                 [f"m{m:02d}" for m in range(1, 13)], _LI_SQL))
def q_cf_monthly_pivot(spark, sf):
    return R.cf_monthly_pivot(_li_gen(spark, sf))


@register("cf_hourly", _a("select plant_name, cast(hour(timestamp) as integer) as hour, avg(generation_mw) as mean_generation_mw, "
                          "avg(generation_mw) / nullif(max(capacity_mw), 0) as capacity_factor from generation group by all",
                          ["mean_generation_mw", "capacity_factor"]))
def q_cf_hourly(spark, sf):
    return R.cf_hourly(_gen(spark, sf))


@register("plant_summary", _a("select plant_name, avg(generation_mw) as avg_generation_mw, max(generation_mw) as peak_generation_mw, "
                              "avg(generation_mw) / nullif(max(capacity_mw), 0) * 100.0 as capacity_factor_pct, "
                              "count(*) as data_points, strftime(min(timestamp), '%Y-%m-%d') as start_date, "
                              "strftime(max(timestamp), '%Y-%m-%d') as end_date from generation group by plant_name",
                              ["avg_generation_mw", "peak_generation_mw", "capacity_factor_pct"]))
def q_plant_summary(spark, sf):
    return R.plant_summary(_gen(spark, sf))


@register("first_row_per_plant", _a("select plant_name, arg_min(plant_type, (timestamp, event_id)) as plant_type, "
                                    "arg_min(capacity_mw, (timestamp, event_id)) as capacity_mw, "
                                    "arg_min(latitude, (timestamp, event_id)) as latitude from generation group by plant_name",
                                    ["capacity_mw", "latitude"]))
def q_first_row_per_plant(spark, sf):
    return R.first_row_per_plant(_gen(spark, sf), ["plant_type", "capacity_mw", "latitude"], tiebreak=TB)


@register("sort_time_plant", _a("select * from generation order by timestamp, plant_name, event_id", GEN_D))
def q_sort_time_plant(spark, sf):
    """Output order (range-partitioned sort; only at the sink)."""
    return _gen(spark, sf).orderBy("timestamp", "plant_name", "event_id")


@register("union_sites", _a("select event_id, plant_name, generation_mw, null::double as wind_speed, "
                            "surface_solar_radiation_downwards from merged where plant_type = 'solar' union all by name "
                            "select event_id, plant_name, generation_mw, wind_speed from merged where plant_type = 'wind'",
                            ["generation_mw", "wind_speed", "surface_solar_radiation_downwards"], O.merged_ctes()))
def q_union_sites(spark, sf):
    m = _merged(spark, sf)
    solar = m.filter(F.col("plant_type") == "solar").select("event_id", "plant_name", "generation_mw", "surface_solar_radiation_downwards")
    wind = m.filter(F.col("plant_type") == "wind").select("event_id", "plant_name", "generation_mw", "wind_speed")
    return solar.unionByName(wind, allowMissingColumns=True)


# --- preprocessing -------------------------------------------------------------
_SC_COLS = ["temperature_2m", "wind_speed", "surface_solar_radiation_downwards", "total_cloud_cover"]
_SCALER = " union all ".join(
    f"select '{c}' as feature, avg({c}) as mean, case when stddev_pop({c}) is null or stddev_pop({c}) = 0 then 1.0 "
    f"else stddev_pop({c}) end as std from merged" for c in _SC_COLS)


@register("scaler_fit", _m(_SCALER, ["mean", "std"]))
def q_scaler_fit(spark, sf):
    return PP.scaler_fit(_merged(spark, sf), _SC_COLS)


_SCALED = ", ".join(f"({c} - (select avg({c}) from merged)) / (select case when stddev_pop({c}) is null or stddev_pop({c}) = 0 then 1.0 "
                    f"else stddev_pop({c}) end from merged) as {c}" for c in _SC_COLS)


@register("scaler_transform", _m(f"select event_id, {_SCALED} from merged", _SC_COLS))
def q_scaler_transform(spark, sf):
    m = _merged(spark, sf).select("event_id", *_SC_COLS)
    return PP.scaler_transform(m, PP.scaler_fit(m, _SC_COLS), _SC_COLS)


@register("scaler_inverse", _m("select event_id, " + ", ".join(_SC_COLS) + " from merged", _SC_COLS))
def q_scaler_inverse(spark, sf):
    """Scaled and scaled back: the original values."""
    m = _merged(spark, sf).select("event_id", *_SC_COLS)
    stats = PP.scaler_fit(m, _SC_COLS)
    return PP.scaler_transform(PP.scaler_transform(m, stats, _SC_COLS), stats, _SC_COLS, inverse=True)


_LE = ("select event_id, plant_name, coalesce(e.label, -1) as plant_name_encoded from generation g left join "
       "(select plant_name as v, cast(row_number() over (order by plant_name) - 1 as integer) as label from "
       "(select distinct plant_name from generation where plant_type = 'solar')) e on g.plant_name = e.v")


@register("label_encode", _a(_LE))
def q_label_encode(spark, sf):
    """Encoder fitted on solar plants only; wind plants are unseen (-1)."""
    g = _gen(spark, sf)
    enc = PP.label_encoder_fit(g.filter(F.col("plant_type") == "solar"), "plant_name")
    return PP.label_encode(g.select("event_id", "plant_name"), enc, "plant_name")


_MI = ("select event_id, " + ", ".join(
    f"coalesce({c}, (select avg({c}) from merged where ((event_id % 1000003 * 2654435761 + 42) % 1000003) % 100 < 80)) as {c}"
    for c in ["temperature_2m", "generation_mw"]) + " from merged")


@register("mean_impute", _m(_MI, ["temperature_2m", "generation_mw"]))
def q_mean_impute(spark, sf):
    """Nulls -> means fitted on the train split only."""
    from wattline.operators.series import split_random
    m = _merged(spark, sf).select("event_id", "temperature_2m", "generation_mw")
    train = split_random(m, "event_id").filter(F.col("split") == "train")
    return PP.mean_impute(m, ["temperature_2m", "generation_mw"], fit=train)


_SEL_COLS = [*W, "hour", "day_of_year", "month", "weekday", "is_weekend"]


@register("select_features", _m("select " + ", ".join(W) + ", " + O.calendar_sql() + " from merged", W))
def q_select_features(spark, sf):
    """Model inputs: meta, target, target-prefixed and leaking columns dropped."""
    m = _merged(spark, sf).withColumns(calendar_columns("timestamp")).withColumn("capacity_factor", P.capacity_factor())
    m = m.withColumn("generation_mw_lag_1h", F.lit(None).cast("double"))
    return FE.select_features(m)


# --- sequences, horizons -------------------------------------------------------
_LB = ("select plant_name, timestamp, cast(len(w) as integer) as window_size, w[1] as first_value, w[24] as last_value, "
       "generation_mw as target from (select plant_name, timestamp, generation_mw, "
       "list(generation_mw) over (partition by plant_name order by timestamp rows between 24 preceding and 1 preceding) as w "
       "from gen_grid) where len(w) = 24")


@register("lookback_sequences", _a(_LB, ["first_value", "last_value", "target"], GEN_GRID))
def q_lookback_sequences(spark, sf):
    g = _gen_grid(spark, sf)
    seq = FE.lookback_sequences(g, ["generation_mw"], 24)
    return seq.select("plant_name", "timestamp", F.size("window").cast("int").alias("window_size"),
                      F.col("window")[0][0].alias("first_value"), F.col("window")[23][0].alias("last_value"), "target")


_MH = ("select o.plant_name, o.timestamp as origin, s.step, o.timestamp + s.step * interval 1 hour as target_time, "
       "t.generation_mw as target from gen_grid o cross join (select unnest(generate_series(1, 24)) as step) s "
       "left join gen_grid t on t.plant_name = o.plant_name and t.timestamp = o.timestamp + s.step * interval 1 hour")


@register("multi_horizon_frame", _a(_MH, ["target"], GEN_GRID))
def q_multi_horizon_frame(spark, sf):
    g = _gen_grid(spark, sf)
    out = multi_horizon_frame(g, "generation_mw", 24)
    return out.withColumn("step", F.col("step").cast("bigint"))


# --- predictions: fallback, range, confidence, rounding, labels ----------------
def _preds_fb(spark, sf):
    p = predictions(spark, sf)
    lo, hi = FF.interval_fallback()
    return p.withColumns({"P10": lo, "P90": hi})


_PFB = "preds_fb as (select * replace (coalesce(P10, P50 * 0.9) as P10, coalesce(P90, P50 * 1.1) as P90) from preds)"


def _p(body, doubles=()):
    return O.wrap(O.with_adapter(body, SERIES + ",\n" + _PFB), list(doubles))


@register("interval_fallback", _p("select model, plant_name, timestamp, P10, P50, P90 from preds_fb", ["P10", "P50", "P90"]))
def q_interval_fallback(spark, sf):
    return _preds_fb(spark, sf).select("model", "plant_name", "timestamp", "P10", "P50", "P90")


@register("interval_serving", _p("select model, plant_name, timestamp, coalesce(P10, P50 * 0.8) as P10, P50, coalesce(P90, P50 * 1.2) as P90 "
                                 "from preds", ["P10", "P50", "P90"]))
def q_interval_serving(spark, sf):
    """The serving answer's wider interval where a model gives none."""
    lo, hi = FF.interval_fallback(factors=C.SERVING_FALLBACK)
    return predictions(spark, sf).select("model", "plant_name", "timestamp", lo.alias("P10"), "P50", hi.alias("P90"))


@register("uncertainty_range", _p("select model, plant_name, timestamp, coalesce(P90, 0.0) - coalesce(P10, 0.0) as "
                                  "uncertainty_range from preds", ["uncertainty_range"]))
def q_uncertainty_range(spark, sf):
    return predictions(spark, sf).select("model", "plant_name", "timestamp", FF.uncertainty_range().alias("uncertainty_range"))


_CONF = ("select model, p.plant_name, p.timestamp, case when r / nullif(cap, 0) < 0.1 then 'High' when r / nullif(cap, 0) < 0.2 "
         "then 'Medium' else 'Low' end as confidence_level from (select *, coalesce(P90, 0.0) - coalesce(P10, 0.0) as r from preds_fb) p "
         "join (select distinct plant_name, capacity_mw as cap from series) c on p.plant_name = c.plant_name")


@register("confidence_level", _p(_CONF))
def q_confidence_level(spark, sf):
    p = _preds_fb(spark, sf).withColumn("r", FF.uncertainty_range())
    caps = series(spark, sf).groupBy("plant_name").agg(F.max("capacity_mw").alias("cap"))
    return p.join(caps, "plant_name").select("model", "plant_name", "timestamp", FF.confidence_level("r", F.col("cap")).alias("confidence_level"))


@register("round_output", _p("select model, plant_name, timestamp, " + ", ".join(
    f"{O.round_even_sql(c, 2)} as {c}" for c in ("P10", "P50", "P90")) + " from preds_fb", ["P10", "P50", "P90"]))
def q_round_output(spark, sf):
    p = _preds_fb(spark, sf)
    return p.select("model", "plant_name", "timestamp", *[FF.round_half_even(c, 2).alias(c) for c in ("P10", "P50", "P90")])


_QL = ("select model, plant_name, timestamp, 'P' || cast(cast(round(q * 100) as integer) as varchar) as quantile, value from "
       "(select model, plant_name, timestamp, unnest([0.1, 0.5, 0.9]) as q, unnest([P10, P50, P90]) as value from preds "
       "where model = 'QuantileBins')")


@register("quantile_label", _p(_QL, ["value"]))
def q_quantile_label(spark, sf):
    p = predictions(spark, sf).filter(F.col("model") == "QuantileBins")
    long = p.select("model", "plant_name", "timestamp", F.explode(F.array(*[
        F.struct(F.lit(q).alias("q"), F.col(c).alias("value")) for q, c in ((0.1, "P10"), (0.5, "P50"), (0.9, "P90"))])).alias("z"))
    return long.select("model", "plant_name", "timestamp", FF.quantile_label(F.col("z.q")).alias("quantile"), F.col("z.value").alias("value"))


@register("name_slug", _a("select event_id, replace(lower(plant_type || ' ' || plant_name), ' ', '_') as slug, "
                          "upper(left(plant_name, 1)) || substr(split_part(plant_name, '_', 1), 2) || ' ' || "
                          "upper(split_part(plant_name, '_', 2)) as title, strftime(timestamp, '%Y-%m-%d') as day from generation"))
def q_name_slug(spark, sf):
    g = _gen(spark, sf)
    return g.select("event_id", FF.name_slug(F.concat_ws(" ", "plant_type", "plant_name")).alias("slug"),
                    FF.display_name("plant_name").alias("title"), F.date_format("timestamp", "yyyy-MM-dd").alias("day"))


_HEAD = (f"select timestamp, plant_name, {O.round_even_sql('y_true', 2)} as actual, {O.round_even_sql('P50', 2)} as predicted, "
         f"{O.round_even_sql('abs(y_true - P50)', 2)} as error from preds where model = 'QuantileBins' order by timestamp, plant_name limit 48")


@register("head_forecast", _p(_HEAD, ["actual", "predicted", "error"]))
def q_head_forecast(spark, sf):
    p = predictions(spark, sf).filter(F.col("model") == "QuantileBins")
    return R.head_forecast(p, 48)


_SS = ("select * from (select event_id, plant_name, timestamp, generation_mw from generation "
       "order by (event_id % 1000003 * 2654435761 + 42) % 1000003, event_id limit 200)")


@register("sample_sorted", _a(_SS, ["generation_mw"]))
def q_sample_sorted(spark, sf):
    """200 deterministic pseudo-random generation rows in time order."""
    return R.sample_sorted(_gen(spark, sf).select("event_id", "plant_name", "timestamp", "generation_mw"), 200, "event_id", 42)


# --- ensembles -------------------------------------------------------------------
_WIDE = ("wide as (select plant_name, timestamp, any_value(y_true) as y_true, "
         "max(P50) filter (where model = 'Persistence') as Persistence, max(P50) filter (where model = 'QuantileBins') as QuantileBins "
         "from preds group by plant_name, timestamp)")


def _wide(spark, sf, on="test"):
    from wattline.operators.joins import join_predictions
    return join_predictions(predictions(spark, sf, on), ["Persistence", "QuantileBins"])


_WIDE_VAL = _WIDE.replace("wide as", "wide_val as").replace("from preds", "from preds_val")


def _e(body, doubles=()):
    return O.wrap(O.with_adapter(body, SERIES + ",\n" + _WIDE), list(doubles))


def _ev(body, doubles=()):
    return O.wrap(O.with_adapter(body, SERIES_VAL + ",\n" + _WIDE + ",\n" + _WIDE_VAL), list(doubles))


@register("join_predictions", _e("select plant_name, timestamp, y_true, Persistence, QuantileBins from wide",
                                 ["y_true", "Persistence", "QuantileBins"]))
def q_join_predictions(spark, sf):
    return _wide(spark, sf)


_WFIT = ("select arg_min(w, struct_pack(m := mae, w := w)) as w_Persistence, 1.0 - arg_min(w, struct_pack(m := mae, w := w)) as w_QuantileBins, "
         "min(mae) as val_mae from (select w, avg(abs(y_true - (w * Persistence + (1.0 - w) * QuantileBins))) as mae from "
         "(select *, unnest(generate_series(0, 100)) / 100.0 as w from wide_val where y_true is not null and Persistence is not null "
         "and QuantileBins is not null) group by w)")


@register("ensemble_weights_fit", _ev(_WFIT, ["w_Persistence", "w_QuantileBins", "val_mae"]))
def q_ensemble_weights_fit(spark, sf):
    """MAE minimisation (step 0.01) for two models on the validation slice."""
    return FC.fit_ensemble_weights(_wide(spark, sf, "val"), ["Persistence", "QuantileBins"], step=0.01)


_EFP = (f"select plant_name, timestamp, least(lo, P50, hi) as P10, lo + P50 + hi - least(lo, P50, hi) - greatest(lo, P50, hi) as P50, "
        f"greatest(lo, P50, hi) as P90 from (select plant_name, timestamp, coalesce(P10, P50 * 0.9) as lo, P50, coalesce(P90, P50 * 1.1) as hi from "
        f"(select plant_name, timestamp, coalesce(sum(weight * P50) / nullif(sum(weight), 0), avg(P50)) as P50, avg(P10) as P10, avg(P90) as P90 "
        f"from preds p left join (select 'Persistence' as model, w_Persistence as weight from w union all select 'QuantileBins', w_QuantileBins from w) z "
        f"on p.model = z.model where P50 is not null group by plant_name, timestamp))")


@register("ensemble_fit_predict", O.wrap(O.with_adapter(_EFP, SERIES_VAL + ",\n" + _WIDE_VAL + f",\nw as ({_WFIT})"), ["P10", "P50", "P90"]))
def q_ensemble_fit_predict(spark, sf):
    """Weights fitted on the validation slice, applied to the test slice; the
    other models have no weight and count only for missing ones."""
    models = ["Persistence", "QuantileBins"]
    fitted = FC.fit_ensemble_weights(_wide(spark, sf, "val"), models, step=0.01)
    weights = fitted.selectExpr("stack(2, " + ", ".join(f"'{m}', w_{m}" for m in models) + ") as (model, weight)")
    return FC.ensemble_predict(predictions(spark, sf), F.broadcast(weights))


@register("ensemble_weighted", _e("select plant_name, timestamp, (coalesce(Persistence * 0.4, 0.0) + coalesce(QuantileBins * 0.6, 0.0)) / "
                                  "nullif((case when Persistence is not null then 0.4 else 0.0 end) + "
                                  "(case when QuantileBins is not null then 0.6 else 0.0 end), 0) as P50 from wide", ["P50"]))
def q_ensemble_weighted(spark, sf):
    w = FC.ensemble_weighted(_wide(spark, sf), {"Persistence": 0.4, "QuantileBins": 0.6})
    return w.select("plant_name", "timestamp", "P50")


@register("ensemble_quantiles", _p("select plant_name, timestamp, avg(P10) as P10, avg(P50) as P50, avg(P90) as P90 from preds "
                                   "where P10 is not null and P50 is not null and P90 is not null group by plant_name, timestamp", ["P10", "P50", "P90"]))
def q_ensemble_quantiles(spark, sf):
    return FC.ensemble_quantiles(predictions(spark, sf))


_EW = "(select * from (values ('Persistence', 0.3), ('Climatology', 0.2), ('QuantileBins', 0.5)) t(model, weight))"
_EP = (f"select plant_name, timestamp, least(lo, P50, hi) as P10, lo + P50 + hi - least(lo, P50, hi) - greatest(lo, P50, hi) as P50, "
       f"greatest(lo, P50, hi) as P90 from (select plant_name, timestamp, coalesce(P10, P50 * 0.9) as lo, P50, coalesce(P90, P50 * 1.1) as hi from "
       f"(select plant_name, timestamp, coalesce(sum(weight * P50) / nullif(sum(weight), 0), avg(P50)) as P50, "
       f"avg(P10) as P10, avg(P90) as P90 from preds p left join {_EW} w on p.model = w.model where P50 is not null group by plant_name, timestamp))")


@register("ensemble_quantiles_median", _p("select plant_name, timestamp, median(P10) as P10, median(P50) as P50, median(P90) as P90 from preds "
                                          "where P10 is not null and P50 is not null and P90 is not null group by plant_name, timestamp",
                                          ["P10", "P50", "P90"]))
def q_ensemble_quantiles_median(spark, sf):
    return FC.ensemble_quantiles(predictions(spark, sf), method="median")



@register("ensemble_predict", _p(_EP, ["P10", "P50", "P90"]))
def q_ensemble_predict(spark, sf):
    weights = spark.createDataFrame([("Persistence", 0.3), ("Climatology", 0.2), ("QuantileBins", 0.5)], "model string, weight double")
    return FC.ensemble_predict(predictions(spark, sf), F.broadcast(weights))


_SQ = ("select plant_name, date_trunc('hour', timestamp) as hour, avg(generation_mw) as mean, stddev_pop(generation_mw) as std, "
       "quantile_cont(generation_mw, 0.1) as P10, quantile_cont(generation_mw, 0.5) as P50, quantile_cont(generation_mw, 0.9) as P90 "
       "from generation where generation_mw is not null group by all")


@register("sample_quantiles", _a(_SQ, ["mean", "std", "P10", "P50", "P90"]))
def q_sample_quantiles(spark, sf):
    """Draws = the generation readings within each plant-hour."""
    g = _gen(spark, sf).filter(F.col("generation_mw").isNotNull()) \
        .withColumn("hour", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
    return FC.sample_quantiles(g, ["plant_name", "hour"], "generation_mw")


# --- importance, serving -------------------------------------------------------
_IMP_FEATS = ["temperature_2m", "wind_speed", "surface_solar_radiation_downwards", "total_cloud_cover",
              "total_precipitation", "surface_pressure", "hour", "day_of_year", "weekday", "capacity_mw", "latitude", "longitude"]


def _imp_input(spark, sf):
    m = _merged(spark, sf)
    return m.withColumns({"hour": F.hour("timestamp"), "day_of_year": F.dayofyear("timestamp"), "weekday": F.weekday("timestamp")})


def _imp_sql() -> str:
    parts = []
    for f in _IMP_FEATS:
        expr = {"hour": "hour(timestamp)", "day_of_year": "dayofyear(timestamp)", "weekday": "isodow(timestamp) - 1"}.get(f, f)
        x = f"case when {expr} is not null and generation_mw is not null then cast({expr} as double) end"
        y = f"case when {expr} is not null and generation_mw is not null then generation_mw end"
        den = f"(stddev_pop({x}) * stddev_pop({y}))"
        parts.append(f"select '{f}' as feature, abs(case when {den} > 0 then covar_pop({x}, {y}) / {den} end) as importance from merged")
    return " union all ".join(parts)


_IMP = _imp_sql()


@register("feature_importance", _m(_IMP, ["importance"]))
def q_feature_importance(spark, sf):
    """|corr(feature, generation)| for every feature (SQL-checkable twin of tree importance)."""
    return FC.correlation_importance(_imp_input(spark, sf), _IMP_FEATS, "generation_mw")


@register("topk_importance", _m(f"select * from ({_IMP}) order by round(importance, 10) desc nulls last, feature limit 10", ["importance"]))
def q_topk_importance(spark, sf):
    imp = FC.correlation_importance(_imp_input(spark, sf), _IMP_FEATS, "generation_mw")
    return FC.top_k(imp, 10)


_BINS_T = ("bins_t as (select plant_type, cast(month(s.timestamp) as integer) as month, cast(hour(s.timestamp) as integer) as hour, "
           "quantile_cont(y_true, [0.1, 0.5, 0.9]) as q from series s join plant p on s.plant_name = p.plant_name "
           "where split in ('train', 'val') group by all)")
_RREASON = ("case " + " ".join(f"when r.{c} is null then 'missing:{c}'" for c in _REQ_REQUIRED)
            + " when not (r.hour between 0 and 23) then 'hour_out_of_range' when not (r.month between 1 and 12) "
              "then 'month_out_of_range' end")
_BF = ("select request_id, plant_type, hour, month, " + ", ".join(f"{O.round_even_sql(c, 2)} as {c}" for c in ("P10", "P50", "P90"))
       + f", {O.round_even_sql('rng', 2)} as uncertainty_range, case when rng / 100.0 < 0.1 then 'High' when rng / 100.0 < 0.2 then 'Medium' "
       "else 'Low' end as confidence_level from (select *, coalesce(P90, 0.0) - coalesce(P10, 0.0) as rng from "
       "(select r.request_id, r.plant_type, r.hour, r.month, coalesce(b.q[1], b.q[2] * 0.9) as P10, b.q[2] as P50, "
       "coalesce(b.q[3], b.q[2] * 1.1) as P90 from requests r left join bins_t b on r.plant_type = b.plant_type "
       f"and r.month = b.month and r.hour = b.hour where ({_RREASON}) is null))")


def _bins_by_type(spark, sf):
    s = series(spark, sf).filter(F.col("split").isin("train", "val"))
    s = s.join(F.broadcast(adapter_plants(spark).select("plant_name", "plant_type")), "plant_name")
    return FC.fit_quantile_bins(FC.add_month_hour(s), keys=("plant_type", "month", "hour"))


@register("batch_forecast", O.wrap(O.with_adapter(_BF, SERIES + ",\n" + _REQ_SQL + ",\n" + _BINS_T),
                                   ["P10", "P50", "P90", "uncertainty_range"]))
def q_batch_forecast(spark, sf):
    """Valid requests scored with per (type, month, hour) quantile bins."""
    req = FL.validate_requests(_requests(spark, sf)).filter("is_valid")
    out = FC.batch_forecast(req, _bins_by_type(spark, sf))
    return out.select("request_id", "plant_type", "hour", "month", "P10", "P50", "P90", "uncertainty_range", "confidence_level")


_EXPL = (f"select request_id, P10, P50, P90, uncertainty_range, confidence_level, "
         f"(select list(feature order by round(importance, 10) desc nulls last, feature)[1:5] from ({_IMP})) as drivers, "
         f"(select list(feature || ' ' || coalesce(printf('%.4f', importance), '-') order by round(importance, 10) desc nulls last, feature)[1:10] "
         f"from ({_IMP})) as importance from ({_BF})")


@register("batch_forecast_total", O.wrap(O.with_adapter(f"select count(*) as total_forecasts, cast(count(P50) as bigint) as with_forecast from ({_BF})",
                                                        SERIES + ",\n" + _REQ_SQL + ",\n" + _BINS_T), []))
def q_batch_forecast_total(spark, sf):
    """How many requests a batch answers."""
    return q_batch_forecast(spark, sf).agg(F.count(F.lit(1)).alias("total_forecasts"), F.count("P50").alias("with_forecast"))


@register("explain_forecast", O.wrap(O.with_adapter(_EXPL, SERIES + ",\n" + _REQ_SQL + ",\n" + _BINS_T + ",\n" + O.merged_ctes()), ["P10", "P50", "P90", "uncertainty_range"]))
def q_explain_forecast(spark, sf):
    """Forecast, interval and confidence, with the top-10 importances and the
    top-5 drivers (correlation importance) per request."""
    req = FL.validate_requests(_requests(spark, sf)).filter("is_valid")
    fc = FC.batch_forecast(req, _bins_by_type(spark, sf))
    imp = FC.top_k(FC.correlation_importance(_imp_input(spark, sf), _IMP_FEATS, "generation_mw"), 10)
    ranked = imp.agg(F.sort_array(F.collect_list(F.struct(  # ten rows
        (-F.coalesce(F.round("importance", 10), F.lit(-1.0))).alias("k"), F.col("feature"), F.col("importance")))).alias("r")).scalar()
    fc = fc.withColumn("_r", ranked)
    shown = F.transform("_r", lambda s: F.concat(s["feature"], F.lit(" "), F.coalesce(F.format_string("%.4f", s["importance"]), F.lit("-"))))
    return fc.select("request_id", "P10", "P50", "P90", "uncertainty_range", "confidence_level",
                     F.slice(F.transform("_r", lambda s: s["feature"]), 1, 5).alias("drivers"), shown.alias("importance"))


_MT_METRICS = ("mae", "rmse", "mape", "picp_80", "mpiw_80")
from wattline.plans.q_eval import _MW  # noqa: E402

_MT = ("select model, " + ", ".join(f"max(case when metric = '{m}' then value end) as {m}" for m in _MT_METRICS)
       + " from metrics_long group by model")


@register("metrics_table", O.wrap(O.with_adapter(_MT, SERIES + ",\n" + _MW), list(_MT_METRICS)))
def q_metrics_table(spark, sf):
    """Model comparison table (point + interval metrics)."""
    long = evaluate_model(predictions(spark, sf))
    return compare_models(long, metrics=_MT_METRICS)


# --- trees (rows-only: Spark ML has no SQL twin) -------------------------------
_GBT_FEATS = ["temperature_2m", "wind_speed", "surface_solar_radiation_downwards", "total_cloud_cover",
              "total_precipitation", "hour", "month", "capacity_mw"]


def _gbt_frame(spark, sf):
    from wattline.operators.series import split_random
    m = _merged(spark, sf).withColumns({"hour": F.hour("timestamp"), "month": F.month("timestamp")}) \
        .withColumnRenamed("generation_mw", "y_true")
    return split_random(m, "event_id")


@register("forecast_point_gbt")
def q_forecast_point_gbt(spark, sf):
    """Boosted trees on 8 base features, 80/20 hash split; test predictions."""
    d = _gbt_frame(spark, sf)
    model = FC.fit_gbt(d.filter(F.col("split") == "train"), _GBT_FEATS)
    pred = FC.gbt_predict(model, d.filter(F.col("split") == "test"), _GBT_FEATS)
    return pred.select("event_id", "plant_name", "timestamp", "y_true", "P50")


def _feature_series(spark, sf):
    """The feature table with row positions, 70/20/10 split and model inputs
    (written once: training passes over it many times)."""
    from wattline.operators.series import row_index, split_chronological
    from wattline.plans.pipeline import pipeline_features
    from wattline.session import materialize
    gen, wea = tables(spark, sf)
    table = pipeline_features(gen, wea, tiebreak=TB).filter(F.col("generation_mw").isNotNull())
    feats = FE.select_features(table, keep_target_history=True).columns
    feats = [c for c, t in table.select(*feats).dtypes if t not in ("string", "array<double>")] + ["capacity_mw"]
    s = materialize(split_chronological(row_index(table.withColumn("y_true", F.col("generation_mw")))))
    return s, feats


@register("forecast_quantile_conformal")
def q_forecast_quantile_conformal(spark, sf):
    """GBT P50 on the whole feature table + split-conformal P10/P90 from
    validation residuals per plant."""
    s, feats = _feature_series(spark, sf)
    model = FC.fit_gbt(s.filter(F.col("split") == "train"), feats)
    val = FC.gbt_predict(model, s.filter(F.col("split") == "val"), feats)
    test = FC.gbt_predict(model, s.filter(F.col("split") == "test"), feats)
    out = FC.conformal_intervals(val, test)
    return out.select("plant_name", "timestamp", "y_true", "P10", "P50", "P90")


@register("tree_importance")
def q_tree_importance(spark, sf):
    """Importance of each input in the boosted trees, largest first."""
    d = _gbt_frame(spark, sf)
    model = FC.fit_gbt(d.filter(F.col("split") == "train"), _GBT_FEATS)
    return spark.createDataFrame(FC.gbt_importance(model, _GBT_FEATS), "feature string, importance double")


@register("metrics_trained")
def q_metrics_trained(spark, sf):
    """Point and interval metrics of the trained learner with conformal intervals."""
    preds = q_forecast_quantile_conformal(spark, sf).withColumn("model", F.lit("GBT_Conformal"))
    return compare_models(evaluate_model(preds))


_ENS = (f"ens as (select 'Ensemble' as model, e.plant_name, e.timestamp, t.y_true, e.P10, e.P50, e.P90 from ({_EFP}) e "
        "join test t on e.plant_name = t.plant_name and e.timestamp = t.timestamp)")
_ENS_COLS = ("mae", "rmse", "nmae", "picp_80", "mpiw_80", "pinball_avg", "crps")


@register("metrics_ensemble", O.wrap(O.with_adapter("select model, " + ", ".join(_ENS_COLS) + " from (" + METRICS_WIDE.replace("from preds", "from ens") + ")",
                                                    SERIES_VAL + ",\n" + _WIDE_VAL + f",\nw as ({_WFIT}),\n" + _ENS), list(_ENS_COLS)))
def q_metrics_ensemble(spark, sf):
    """Metrics of the ensemble whose weights were fitted on the validation slice."""
    truth = series(spark, sf).filter(F.col("split") == "test").select("plant_name", "timestamp", "y_true")
    preds = q_ensemble_fit_predict(spark, sf).join(truth, ["plant_name", "timestamp"]).withColumn("model", F.lit("Ensemble"))
    return compare_models(evaluate_model(preds), metrics=_ENS_COLS)


# --- dimensions derived from the facts, persistence round trips ----------------
_PD = ("select plant_name, arg_min(plant_type, (timestamp, event_id)) as plant_type, "
       "arg_min(capacity_mw, (timestamp, event_id)) as capacity_mw, arg_min(latitude, (timestamp, event_id)) as latitude, "
       "arg_min(longitude, (timestamp, event_id)) as longitude, cast(min(timestamp) as date) as commission_date "
       "from generation group by plant_name")


@register("plant_dim", _a(_PD, ["capacity_mw", "latitude", "longitude"]))
def q_plant_dim(spark, sf):
    """Plant registry (name, type, capacity, coordinates, first day) built
    from the generation facts: one partial aggregation."""
    g = _gen(spark, sf)
    first = R.first_row_per_plant(g, ["plant_type", "capacity_mw", "latitude", "longitude"], tiebreak=TB)
    days = g.groupBy("plant_name").agg(F.to_date(F.min("timestamp")).alias("commission_date"))
    return first.join(days, "plant_name")


@register("location_dim", _a("select location, count(*) as readings, min(timestamp) as first_seen, max(timestamp) as last_seen "
                             "from weather group by location"))
def q_location_dim(spark, sf):
    """Measurement-site registry from the weather facts."""
    _, wea = tables(spark, sf)
    return wea.groupBy("location").agg(F.count(F.lit(1)).alias("readings"), F.min("timestamp").alias("first_seen"),
                                       F.max("timestamp").alias("last_seen"))


_SINK_SQL, _SINK_D = O.pipeline_sql()


@register("sink_features", O.wrap(_SINK_SQL, _SINK_D))
def q_sink_features(spark, sf):
    """The full feature table written partitioned by plant to the shared
    checkpoint folder, read back whole."""
    from wattline.plans.pipeline import pipeline_features
    from wattline.session import stage_path
    from wattline.sources.sinks import write_features
    gen, wea = tables(spark, sf)
    feats = pipeline_features(gen, wea, tiebreak=TB)
    path = stage_path(spark, "features")
    write_features(feats, path)
    return spark.read.parquet(path).select(*feats.columns)


@register("model_persist", O.wrap(O.with_adapter("select plant_name, timestamp, y_true, P10, P50, P90 from preds "
                                                 "where model = 'QuantileBins'", SERIES), ["y_true", "P10", "P50", "P90"]))
def q_model_persist(spark, sf):
    """Quantile bins fitted, saved with their metadata, loaded back and
    applied to the test slice."""
    from wattline.operators.persist import load_model, save_model
    from wattline.session import stage_path
    s = series(spark, sf)
    bins = FC.fit_quantile_bins(FC.add_month_hour(s.filter(F.col("split").isin("train", "val"))))
    path = stage_path(spark, "model")
    save_model(path, {"bins": bins}, meta={"keys": ["plant_name", "month", "hour"]})
    tables_, _, meta = load_model(spark, path)
    test = FC.add_month_hour(s.filter(F.col("split") == "test").select("plant_name", "timestamp", "y_true"))
    out = FC.predict_quantile_bins(test, tables_["bins"], meta["keys"])
    return out.select("plant_name", "timestamp", "y_true", "P10", "P50", "P90")

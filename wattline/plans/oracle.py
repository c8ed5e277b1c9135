"""DuckDB oracle SQL for the registered queries.

These strings are the independent second implementation the driver runs
next to the Spark plans.  Builders generate the repetitive parts (one
window column per lag / window / weather column) from the same fixed
lists the library uses.  Floats are compared as ``round(x + 1e-9, 6)`` on
both sides.
"""

from __future__ import annotations

from wattline import config as C
from wattline.sources.adapter import ADAPTER_PLANTS, N_SITES

TWO_PI = "6.283185307179586"
PI = "3.141592653589793"

K = "cast(json_extract_string(props, '$.k') as double)"


def plant_values() -> str:
    rows = ",".join(f"({p},'{n}','{t}',{c},{la},{lo})" for p, n, t, c, la, lo in ADAPTER_PLANTS)
    return (
        "select cast(pid as bigint) pid, plant_name, plant_type, cast(capacity_mw as double) capacity_mw, "
        "cast(latitude as double) latitude, cast(longitude as double) longitude, "
        f"'site_' || cast(pid % {N_SITES} as varchar) as location "
        f"from (values {rows}) p(pid, plant_name, plant_type, capacity_mw, latitude, longitude)"
    )


def adapter_ctes() -> str:
    """``plant``, ``generation``, ``weather`` CTE bodies (no leading WITH)."""
    n = len(ADAPTER_PLANTS)
    return f"""plant as ({plant_values()}),
generation as (
  select ts as timestamp, event_id, plant_name, plant_type, capacity_mw,
         case when event_id % 23 = 0 then null when event_id % 97 = 0 then -1.0
              else value*capacity_mw/200.0 end as generation_mw,
         latitude, longitude
  from events join plant on user_id % {n} = pid where event_type <> 'view'),
weather as (
  select date_trunc('hour', ts) as timestamp, 'site_' || cast(user_id % {N_SITES} as varchar) as location,
         case when event_id % 17 = 0 then null else 10 + {K}*0.5 end as temperature_2m,
         cast(user_id % 30 as double) as wind_speed,
         value*6.0 as surface_solar_radiation_downwards,
         {K} as total_cloud_cover, value/100.0 as total_precipitation,
         95000 + {K}*50.0 as surface_pressure
  from events where event_type = 'view')"""


def round_even_sql(expr: str, digits: int) -> str:
    """Twin of ``functions.forecast.round_half_even``: drop binary noise at 9
    decimals, then half-even on the decimal value."""
    return f"cast(round_even(cast(cast(round({expr}, 9) as varchar) as decimal(38, 12)), {digits}) as double)"


def r6(expr: str) -> str:
    return f"round(({expr}) + 1e-9, 6)"


def wrap(sql: str, doubles: list[str] | tuple[str, ...]) -> str:
    """Round the listed double columns of a query the same way as Spark."""
    if not doubles:
        return sql
    rep = ", ".join(f"{r6(f'q.{c}')} as {c}" for c in doubles)
    return f"select * replace ({rep}) from ({sql}) q"


def with_adapter(body: str, extra_ctes: str = "") -> str:
    ctes = adapter_ctes() + ((",\n" + extra_ctes) if extra_ctes else "")
    return f"with {ctes}\n{body}"


# ---------------------------------------------------------------------------
# carry-style window helpers (plain windows; the oracle has no scale concern)
# ---------------------------------------------------------------------------

def _prev_next(cols, part: str, order: str, rn: str = "rn") -> str:
    wb = f"(partition by {part} order by {order} rows between unbounded preceding and current row)"
    wf = f"(partition by {part} order by {order} rows between current row and unbounded following)"
    out = []
    for c in cols:
        out += [
            f"last_value(case when {c} is not null then {rn} end ignore nulls) over {wb} as {c}__prn",
            f"last_value(case when {c} is not null then timestamp end ignore nulls) over {wb} as {c}__pt",
            f"last_value({c} ignore nulls) over {wb} as {c}__pv",
            f"first_value(case when {c} is not null then {rn} end ignore nulls) over {wf} as {c}__nrn",
            f"first_value(case when {c} is not null then timestamp end ignore nulls) over {wf} as {c}__nt",
            f"first_value({c} ignore nulls) over {wf} as {c}__nv",
        ]
    return ",\n  ".join(out)


def _us(a: str) -> str:
    return f"epoch_us({a})"


def interp_sql(c: str, limit: int, method: str, rn: str = "rn") -> str:
    if method == "time":
        num = f"cast({_us('timestamp')} - {_us(c + '__pt')} as double)"
        den = f"cast({_us(c + '__nt')} - {_us(c + '__pt')} as double)"
    else:
        num = f"cast({rn} - {c}__prn as double)"
        den = f"cast({c}__nrn - {c}__prn as double)"
    val = f"{c}__pv + ({c}__nv - {c}__pv) * ({num} / nullif({den}, 0))"
    return (
        f"case when {c} is not null then {c} when {c}__prn is null then null "
        f"when {rn} - {c}__prn > {limit} then null when {c}__nrn is null then {c}__pv "
        f"else coalesce({val}, {c}__pv) end"
    )


def fill_sql(c: str, ffill: int | None, bfill: int | None, rn: str = "rn") -> str:
    parts = [f"when {c} is not null then {c}"]
    if ffill is not None:
        parts.append(f"when {c}__prn is not null and {rn} - {c}__prn <= {ffill} then {c}__pv")
    if bfill is not None:
        parts.append(f"when {c}__nrn is not null and {c}__nrn - {rn} <= {bfill} then {c}__nv")
    return "case " + " ".join(parts) + " end"


WCOLS = list(C.WEATHER_COLS)


def merged_ctes() -> str:
    """wagg + merged (nearest as-of, ties -> earlier)."""
    wavg = ", ".join(f"avg({c}) as {c}" for c in WCOLS)
    pick = ", ".join(
        f"case when choose_prev then p_{c} else n_{c} end as {c}" for c in WCOLS
    )
    pcols = ", ".join(f"pb.{c} as p_{c}" for c in WCOLS)
    ncols = ", ".join(f"nb.{c} as n_{c}" for c in WCOLS)
    return f"""wagg as (select timestamp, {wavg} from weather group by timestamp),
asof_pair as (
  select g.*, pb.timestamp as p_ts, nb.timestamp as n_ts, {pcols}, {ncols}
  from generation g
  asof left join wagg pb on g.timestamp >= pb.timestamp
  asof left join wagg nb on g.timestamp <= nb.timestamp),
merged as (
  select timestamp, event_id, plant_name, plant_type, capacity_mw, generation_mw, latitude, longitude, {pick}
  from (select *, (n_ts is null or (p_ts is not null and
        {_us('timestamp')} - {_us('p_ts')} <= {_us('n_ts')} - {_us('timestamp')})) as choose_prev
        from asof_pair))"""


def repaired_ctes(limit: int = C.MAX_GAP_ROWS, fill: int = C.FILL_LIMIT_ROWS) -> str:
    base = ["timestamp", "event_id", "plant_name", "plant_type", "capacity_mw", "latitude", "longitude"]
    order = "timestamp, event_id"
    c1 = WCOLS + ["generation_mw"]
    interp = ", ".join(
        f"{interp_sql(c, limit, 'linear' if c == 'generation_mw' else 'time')} as {c}" for c in c1
    )
    fills = ", ".join(f"{fill_sql(c, fill, fill)} as {c}" for c in WCOLS)
    keep = ", ".join(base)
    return f"""rp0 as (select *, row_number() over (partition by plant_name order by {order}) as rn from merged),
rp1 as (select *, {_prev_next(c1, 'plant_name', order)} from rp0),
rp2 as (select {keep}, rn, {interp} from rp1),
rp3 as (select *, {_prev_next(WCOLS, 'plant_name', order)} from rp2),
repaired as (select {keep}, generation_mw, {fills} from rp3
  where generation_mw is not null and plant_name is not null and timestamp is not null)"""


STATICS = ["capacity_mw", "plant_type", "latitude", "longitude"]


def aligned_ctes(limit: int = C.MAX_GAP_ROWS) -> str:
    mean_cols = ["generation_mw"] + WCOLS
    avgs = ", ".join(f"avg({c}) as {c}" for c in mean_cols)
    firsts = ", ".join(
        f"arg_min({c}, timestamp) filter (where {c} is not null) as {c}" for c in STATICS
    )
    interp = ", ".join(f"{interp_sql(c, limit, 'time')} as {c}" for c in mean_cols)
    statics = ", ".join(f"coalesce({c}, {c}__pv, {c}__nv) as {c}" for c in STATICS)
    return f"""hourly as (select plant_name, date_trunc('hour', timestamp) as timestamp, {avgs}, {firsts}
  from repaired group by plant_name, date_trunc('hour', timestamp)),
bounds as (select plant_name, min(timestamp) lo, max(timestamp) hi from hourly group by plant_name),
spine as (select plant_name, unnest(generate_series(lo, hi, interval 1 hour)) as timestamp from bounds),
grid0 as (select s.plant_name, s.timestamp, {', '.join('h.' + c for c in mean_cols + STATICS)}
  from spine s left join hourly h on s.plant_name = h.plant_name and s.timestamp = h.timestamp),
grid1 as (select *, row_number() over (partition by plant_name order by timestamp) as rn from grid0),
grid2 as (select *, {_prev_next(mean_cols + STATICS, 'plant_name', 'timestamp')} from grid1),
aligned as (select plant_name, timestamp, {interp}, {statics} from grid2)"""


def calendar_sql(ts: str = "timestamp") -> str:
    return (
        f"cast(hour({ts}) as integer) as hour, cast(dayofyear({ts}) as integer) as day_of_year, "
        f"cast(month({ts}) as integer) as month, cast(isodow({ts}) - 1 as integer) as weekday, "
        f"cast(case when isodow({ts}) in (6, 7) then 1 else 0 end as integer) as is_weekend"
    )


def cyclical_sql() -> str:
    out = []
    for name, col, period in (("hour", "hour", "24.0"), ("month", "month", "12.0"), ("dayofyear", "day_of_year", "365.25")):
        out.append(f"sin({TWO_PI} * cast({col} as double) / {period}) as {name}_sin")
        out.append(f"cos({TWO_PI} * cast({col} as double) / {period}) as {name}_cos")
    return ", ".join(out)


def window_feature_sql(target: str = "generation_mw", part: str = "plant_name") -> tuple[str, list[str]]:
    w = f"partition by {part} order by timestamp"
    cols, names = [], []
    for n in C.LAGS:
        for c in (target, *C.KEY_WEATHER_COLS):
            cols.append(f"lag({c}, {n}) over ({w}) as {c}_lag_{n}h")
            names.append(f"{c}_lag_{n}h")
    fn = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    for n in C.ROLLING_WINDOWS:
        fr = f"({w} rows between {n - 1} preceding and current row)"
        for s in ("mean", "std", "min", "max"):
            cols.append(f"{fn[s]}({target}) over {fr} as {target}_roll_{s}_{n}h")
            names.append(f"{target}_roll_{s}_{n}h")
        for c in C.KEY_WEATHER_COLS:
            cols.append(f"avg({c}) over {fr} as {c}_roll_mean_{n}h")
            names.append(f"{c}_roll_mean_{n}h")
    return ", ".join(cols), names


def wind_category_sql(v: str = "wind_speed") -> str:
    parts = " ".join(f"when {v} > {lo} and {v} <= {hi} then '{lab}'" for lo, hi, lab in C.WIND_SPEED_BINS)
    return f"case {parts} end"


def domain_exprs() -> dict[str, str]:
    """Domain feature name -> DuckDB expression (twin of features.domain_columns)."""
    irr, t, ws, sp = "surface_solar_radiation_downwards", "temperature_2m", "wind_speed", "surface_pressure"
    clear = (f"(1000.0 * greatest(0.0, sin({PI} * (cast(hour as double) - 6.0) / 12.0)) * "
             f"(1.0 + 0.033 * cos({TWO_PI} * day_of_year / 365.0)))")
    den = f"(case when {clear} = 0 then 1.0 else {clear} end)"
    csi = f"{irr} / {den}"
    return {
        "clear_sky_index": f"case when plant_type = 'solar' and {irr} is not null then least(greatest({csi}, 0.0), 2.0) end",
        "irradiance_temp_adjusted": f"case when plant_type = 'solar' then {irr} * (1.0 - 0.005 * ({t} - 25.0)) end",
        "wind_power_density": (f"case when plant_type = 'wind' then 0.5 * ({sp} / ({C.GAS_CONSTANT_AIR} * ({t} + {C.KELVIN}))) "
                               f"* ({ws} * {ws} * {ws}) end"),
        "wind_speed_category": f"case when plant_type = 'wind' then {wind_category_sql(ws)} end",
        "capacity_factor": "generation_mw / nullif(capacity_mw, 0)",
    }


def domain_sql() -> str:
    return ", ".join(f"{e} as {n}" for n, e in domain_exprs().items())


def clip_sql(c: str, lo: str, hi: str) -> str:
    return f"case when {c} is null then null when {c} > {hi} then {hi} when {c} < {lo} then {lo} else {c} end"


def clip_generation_sql() -> str:
    up = "case when capacity_mw is not null and generation_mw > capacity_mw * 1.1 then capacity_mw * 1.1 else generation_mw end"
    return f"case when generation_mw is null then null when ({up}) < 0 then 0.0 else ({up}) end"


def features_ctes() -> tuple[str, list[str]]:
    """Full feature table CTE ``features``; returns (ctes, double column names)."""
    wsql, wnames = window_feature_sql()
    clip_cols = {
        "temperature_2m": ("-10.0", "60.0"),
        "wind_speed": ("0.0", "50.0"),
        "surface_solar_radiation_downwards": ("0.0", "1500.0"),
    }
    clip_rep = ", ".join(
        [f"{clip_generation_sql()} as generation_mw"]
        + [f"{clip_sql(c, lo, hi)} as {c}" for c, (lo, hi) in clip_cols.items()]
    )
    ctes = f"""f1 as (select *, {calendar_sql()} from aligned),
f2 as (select *, {cyclical_sql()} from f1),
f3 as (select *, {wsql} from f2),
f4 as (select *, {domain_sql()} from f3),
features as (select * replace ({clip_rep}) from f4)"""
    doubles = (["generation_mw", "capacity_mw", "latitude", "longitude"] + WCOLS
               + ["hour_sin", "hour_cos", "month_sin", "month_cos", "dayofyear_sin", "dayofyear_cos"]
               + wnames + ["clear_sky_index", "irradiance_temp_adjusted", "wind_power_density", "capacity_factor"])
    return ctes, doubles


def pipeline_sql(select: str = "select * from features") -> tuple[str, list[str]]:
    fctes, doubles = features_ctes()
    ctes = ",\n".join([merged_ctes(), repaired_ctes(), aligned_ctes(), fctes])
    return with_adapter(select, ctes), doubles


# ---------------------------------------------------------------------------
# least squares by elimination, one column for each matrix entry
# ---------------------------------------------------------------------------

def linear_ctes(name: str, source: str, y: str, features: list[str], key: str = "plant_name") -> str:
    """CTEs ending in ``name`` (key, n, intercept, w0, w1, ..): least squares of ``y`` for each key."""
    k = len(features)
    ok = " and ".join(f"{c} is not null" for c in [y, *features])
    sums = [f"avg({c}) as m{i}" for i, c in enumerate(features)] + [f"covar_pop({c}, {y}) as b{i}" for i, c in enumerate(features)]
    sums += [f"covar_pop({features[i]}, {features[j]}) as c{i}_{j}" for i in range(k) for j in range(i, k)]
    keep = f"{key}, n, my, " + ", ".join(f"m{i}, s{i}" for i in range(k))
    unit = [f"coalesce(c{min(i, j)}_{max(i, j)} / nullif(sqrt(c{i}_{i}) * sqrt(c{j}_{j}), 0), 0) as a{i}_{j}" for i in range(k) for j in range(k)]
    unit += [f"coalesce(b{i} / nullif(sqrt(c{i}_{i}), 0), 0) as a{i}_{k}" for i in range(k)]
    out = [f"{name}_s as (select {key}, count(*) as n, avg({y}) as my, {', '.join(sums)} from {source} where {ok} group by {key})",
           f"{name}_e0 as (select {key}, n, my, {', '.join(f'm{i}, sqrt(c{i}_{i}) as s{i}' for i in range(k))}, {', '.join(unit)} from {name}_s)"]
    every = ", ".join(f"a{i}_{j}" for i in range(k) for j in range(k + 1))
    for p in range(k):
        scaled = ", ".join(f"case when a{p}_{p} > 1e-9 then a{p}_{j} / a{p}_{p} else 0.0 end as d{j}" for j in range(k + 1))
        rows = ", ".join(f"d{j} as a{p}_{j}" if i == p else f"a{i}_{j} - a{i}_{p} * d{j} as a{i}_{j}" for i in range(k) for j in range(k + 1))
        out += [f"{name}_d{p} as (select {keep}, {every}, {scaled} from {name}_e{p})", f"{name}_e{p + 1} as (select {keep}, {rows} from {name}_d{p})"]
    weights = ", ".join(f"coalesce(a{i}_{k} / nullif(s{i}, 0), 0.0) as w{i}" for i in range(k))
    means = " - ".join(["my", *[f"w{i} * m{i}" for i in range(k)]])
    out += [f"{name}_w as (select {keep}, {weights} from {name}_e{k})",
            f"{name} as (select {key}, n, {means} as intercept, {', '.join(f'w{i}' for i in range(k))} from {name}_w)"]
    return ",\n".join(out)


def linear_sql(features: list[str], model: str) -> str:
    return " + ".join([f"{model}.intercept", *[f"{model}.w{i} * {c}" for i, c in enumerate(features)]])

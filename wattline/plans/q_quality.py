"""Registered queries: data-quality checks, summaries, reports."""

from __future__ import annotations


from wattline import config as C
from wattline.operators import quality as Q
from wattline.operators.joins import merge_weather
from wattline.plans import oracle as O
from wattline.plans.registry import register, tables
from wattline.session import stage_path
from wattline.sources.sinks import write_report

W = list(C.WEATHER_COLS)
TB = ("event_id",)
MCOLS = ["timestamp", "event_id", "plant_name", "plant_type", "capacity_mw", "generation_mw",
         "latitude", "longitude", *W]


def _qin(spark, sf):
    gen, wea = tables(spark, sf)
    return merge_weather(gen, wea, W)


def _sql(body: str, doubles=()) -> str:
    return O.wrap(O.with_adapter(body, O.merged_ctes()), list(doubles))


def _nulls_sum(cols=MCOLS) -> str:
    return " + ".join(f"(count(*) - count({c}))" for c in cols)


_NULL_PROFILE = " union all ".join(
    f"select '{c}' as column, cast(count(*) - count({c}) as bigint) as null_count from merged" for c in MCOLS)


@register("null_profile", _sql(_NULL_PROFILE))
def q_null_profile(spark, sf):
    return Q.null_profile(_qin(spark, sf))


_N = len(MCOLS)
_MO = (f"select count(*) as rows, {_N} as columns, cast({_nulls_sum()} as bigint) as missing_cells, "
       f"({_nulls_sum()}) * 100.0 / nullif(count(*) * {_N}, 0) as missing_pct, "
       f"coalesce(({_nulls_sum()}) * 100.0 / nullif(count(*) * {_N}, 0), 0) <= {C.MAX_MISSING_PCT} as passed from merged")


@register("missing_overall", _sql(_MO, ["missing_pct"]))
def q_missing_overall(spark, sf):
    return Q.missing_overall(_qin(spark, sf))


_MC = " union all ".join(
    f"select '{c}' as column, (count(*) - count({c})) * 100.0 / nullif(count(*), 0) as missing_pct, "
    f"(count(*) - count({c})) * 100.0 / nullif(count(*), 0) > {C.MAX_MISSING_PCT} as high_missing from merged"
    for c in MCOLS)


@register("missing_by_column", _sql(_MC, ["missing_pct"]))
def q_missing_by_column(spark, sf):
    return Q.missing_by_column(_qin(spark, sf))


_MP = (f"select plant_name, ({_nulls_sum()}) * 100.0 / nullif(count(*) * {_N}, 0) as missing_pct, "
       f"({_nulls_sum()}) * 100.0 / nullif(count(*) * {_N}, 0) > {C.MAX_MISSING_PCT} as high_missing "
       f"from merged group by plant_name")


@register("missing_by_plant", _sql(_MP, ["missing_pct"]))
def q_missing_by_plant(spark, sf):
    return Q.missing_by_plant(_qin(spark, sf))


_DUP = ("select cast(coalesce(sum(c - 1), 0) as bigint) as duplicates from "
        "(select count(*) as c from merged group by timestamp, plant_name)")


@register("duplicate_keys", _sql(_DUP))
def q_duplicate_keys(spark, sf):
    return Q.duplicate_keys(_qin(spark, sf))


_DT = ("(select plant_name, cast(epoch_us(timestamp) - epoch_us(lag(timestamp) over (partition by plant_name "
       "order by timestamp, event_id)) as double) / 1e6 as dt from merged)")
_GS = (f"select plant_name, count(*) as total_points, cast(count_if(dt > 3600.0) as bigint) as gaps_count, "
       f"coalesce(max(case when dt > 3600.0 then dt / 3600.0 end), 0.0) as max_gap_hours from {_DT} group by plant_name")


@register("gap_summary", _sql(_GS, ["max_gap_hours"]))
def q_gap_summary(spark, sf):
    return Q.gap_summary(_qin(spark, sf), tiebreak=TB)


_GF = (f"select plant_name, gaps_count, gaps_count > (select count(*) from merged) * {C.GAP_SHARE} as excessive_gaps "
       f"from ({_GS})")


@register("gap_flag", _sql(_GF))
def q_gap_flag(spark, sf):
    return Q.gap_flag(_qin(spark, sf), tiebreak=TB)


_MPC = (f"select plant_name, count(*) as points, count(*) >= {C.MIN_DATA_POINTS} as passed "
        f"from merged group by plant_name")


@register("min_points_check", _sql(_MPC))
def q_min_points_check(spark, sf):
    return Q.min_points_check(_qin(spark, sf))


_GB = ("select cast(count_if(generation_mw < 0) as bigint) as negative_count, "
       "cast(count_if(generation_mw > capacity_mw * 1.1) as bigint) as over_capacity_count from merged")


@register("generation_bounds", _sql(_GB))
def q_generation_bounds(spark, sf):
    return Q.generation_bounds(_qin(spark, sf))


_WB = " union all ".join(
    f"select '{c}' as column, cast({lo} as double) as min_value, cast({hi} as double) as max_value, "
    f"cast(count_if({c} < {lo} or {c} > {hi}) as bigint) as out_of_range from merged" for c, (lo, hi) in C.WEATHER_RANGES.items())


@register("weather_bounds", _sql(_WB, ["min_value", "max_value"]))
def q_weather_bounds(spark, sf):
    return Q.weather_bounds(_qin(spark, sf))


def _corr_sql(x: str, y: str, cond: str) -> str:
    xa, ya = f"case when {cond} and {x} is not null and {y} is not null then {x} end", \
        f"case when {cond} and {x} is not null and {y} is not null then {y} end"
    den = f"(stddev_pop({xa}) * stddev_pop({ya}))"
    return f"case when {den} > 0 then covar_pop({xa}, {ya}) / {den} end"


_SOLAR_COND = "plant_type = 'solar' and hour(timestamp) between 6 and 18"
_WIND_COND = "plant_type = 'wind'"


def _corr_q(cond, other, thr):
    c = _corr_sql("generation_mw", other, cond)
    return (f"select cast(count_if({cond}) as bigint) as rows, {c} as correlation, {thr} as threshold, "
            f"{c} < {thr} as weak from merged")


@register("corr_solar_irradiance", _sql(_corr_q(_SOLAR_COND, "surface_solar_radiation_downwards", C.SOLAR_CORR_MIN),
                                        ["correlation", "threshold"]))
def q_corr_solar(spark, sf):
    return Q.corr_check(_qin(spark, sf), "solar")


@register("corr_wind_speed", _sql(_corr_q(_WIND_COND, "wind_speed", C.WIND_CORR_MIN), ["correlation", "threshold"]))
def q_corr_wind(spark, sf):
    return Q.corr_check(_qin(spark, sf), "wind")


# --- the long check table, its summary, report and head ---------------------
def _check_rows_sql() -> str:
    n = "count(*)"
    rows = []

    def row(check, item, value, thr, sev, flagged, fails):
        thr_s = "cast(null as double)" if thr is None else f"cast({thr} as double)"
        rows.append(
            f"select '{check}' as \"check\", {item} as item, cast({value} as double) as value, {thr_s} as threshold, "
            f"'{sev}' as severity, coalesce({flagged}, false) as flagged, coalesce({flagged}, false) and {str(fails).lower()} as fails_check")

    overall = f"({_nulls_sum()}) * 100.0 / nullif({n} * {_N}, 0)"
    row("completeness", "'overall_missing_pct'", overall, C.MAX_MISSING_PCT, "issue", f"{overall} > {C.MAX_MISSING_PCT}", True)
    rows[-1] += " from merged"
    for c in MCOLS:
        pct = f"(count(*) - count({c})) * 100.0 / nullif(count(*), 0)"
        row("completeness", f"'column:{c}'", pct, C.MAX_MISSING_PCT, "warning", f"{pct} > {C.MAX_MISSING_PCT}", False)
        rows[-1] += " from merged"
    row("physical", "'negative_generation'", "count_if(generation_mw < 0)", 0.0, "issue", "count_if(generation_mw < 0) > 0", False)
    rows[-1] += " from merged"
    row("physical", "'over_generation'", "count_if(generation_mw > capacity_mw * 1.1)", 0.0, "warning",
        "count_if(generation_mw > capacity_mw * 1.1) > 0", False)
    rows[-1] += " from merged"
    for c, (lo, hi) in C.WEATHER_RANGES.items():
        v = f"count_if({c} < {lo} or {c} > {hi})"
        row("physical", f"'range:{c}'", v, 0.0, "warning", f"{v} > 0", False)
        rows[-1] += " from merged"
    cs = _corr_sql("generation_mw", "surface_solar_radiation_downwards", _SOLAR_COND)
    row("physical", "'solar_irradiance_correlation'", cs, C.SOLAR_CORR_MIN, "warning",
        f"count_if({_SOLAR_COND}) > 0 and {cs} < {C.SOLAR_CORR_MIN}", False)
    rows[-1] += " from merged"
    cw = _corr_sql("generation_mw", "wind_speed", _WIND_COND)
    row("physical", "'wind_speed_correlation'", cw, C.WIND_CORR_MIN, "warning",
        f"count_if({_WIND_COND}) > 0 and {cw} < {C.WIND_CORR_MIN}", False)
    rows[-1] += " from merged"
    pct = f"({_nulls_sum()}) * 100.0 / nullif(count(*) * {_N}, 0)"
    row("completeness", "'plant:' || plant_name", pct, C.MAX_MISSING_PCT, "warning", f"{pct} > {C.MAX_MISSING_PCT}", False)
    rows[-1] += " from merged group by plant_name"
    row("temporal", "'duplicate_keys'", "duplicates", 0.0, "warning", "duplicates > 0", False)
    rows[-1] += f" from ({_DUP})"
    row("temporal", "'gaps:' || plant_name", "gaps_count", C.GAP_SHARE, "warning", "excessive_gaps", False)
    rows[-1] += f" from ({_GF})"
    row("structure", "'empty'", "case when count(*) = 0 then 1.0 else 0.0 end", 0.0, "issue", "count(*) = 0", True)
    rows[-1] += " from (select 1 from merged limit 1)"
    return " union all ".join(rows)


_CHECKS = _check_rows_sql()


@register("sink_report", _sql(_CHECKS, ["value", "threshold"]))
def q_sink_report(spark, sf):
    """Quality report lines (check, item, value, threshold, severity, flags),
    written to the shared folder and read back."""
    report = Q.check_table(_qin(spark, sf), tiebreak=TB)
    path = stage_path(spark, "report")
    write_report(report, path)
    return spark.read.schema(report.schema).json(path)


_MESSAGES = (f"select severity, \"check\" || ': ' || item || case when item like '%\\_correlation' escape '\\' then ' below' else ' above' end || ' its limit' as message from ({_CHECKS}) where flagged")


@register("validation_messages", _sql(_MESSAGES))
def q_validation_messages(spark, sf):
    """One prefixed message per flagged check row."""
    return Q.check_messages(Q.check_table(_qin(spark, sf), tiebreak=TB))


_SUMMARY = (f"select not coalesce(max(cast(fails_check as integer)) = 1, false) as overall_passed, "
            f"cast(count_if(flagged and severity = 'issue') as bigint) as total_issues, "
            f"cast(count_if(flagged and severity = 'warning') as bigint) as total_warnings from ({_CHECKS})")


@register("validation_summary", _sql(_SUMMARY))
def q_validation_summary(spark, sf):
    return Q.validation_summary(Q.check_table(_qin(spark, sf), tiebreak=TB))


_HEAD = (f"select cast(row_number() over (order by \"check\", item) as integer) as rank, \"check\", item, value, "
         f"cast(greatest((select count(*) from ({_CHECKS}) where flagged and severity = 'warning') - 5, 0) as bigint) as more "
         f"from ({_CHECKS}) where flagged and severity = 'warning' order by \"check\", item limit 5")


@register("issue_head", _sql(_HEAD, ["value"]))
def q_issue_head(spark, sf):
    """First 5 warnings and how many more."""
    return Q.issue_head(Q.check_table(_qin(spark, sf), tiebreak=TB), 5, "warning")


_DS = (f"select count(*) as rows, {_N} as columns, count(distinct plant_name) as plants, "
       f"array_to_string(list_sort(list(distinct plant_type)), ',') as plant_types, min(timestamp) as start, "
       f"max(timestamp) as \"end\" from merged")


@register("dataset_summary", _sql(_DS))
def q_dataset_summary(spark, sf):
    return Q.dataset_summary(_qin(spark, sf))


_SC = ("select '' as missing_columns, true as timestamp_is_datetime, (select count(*) from merged) = 0 as empty, "
       "(select count(*) from merged) > 0 as passed")


@register("structure_check", _sql(_SC))
def q_structure_check(spark, sf):
    return Q.structure_check(_qin(spark, sf))

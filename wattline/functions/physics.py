"""Physical and domain expressions (solar, wind, units)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattline import config as C


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clip(x: str | Column, lo: float | Column | None = None, hi: float | Column | None = None) -> Column:
    """Null-preserving clip (``greatest``/``least`` alone turn NULL into a bound)."""
    c = _c(x)
    out = c
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(float(hi)))
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(float(lo)))
    return F.when(c.isNotNull(), out)


def clear_sky_index(irr="surface_solar_radiation_downwards", hour="hour", doy="day_of_year",
                    plant_type="plant_type") -> Column:
    """Irradiance / simple clear-sky irradiance, zero denominators -> 1, clip [0, 2]; solar only."""
    elev = F.greatest(F.lit(0.0), F.sin(F.lit(math.pi) * (_c(hour).cast("double") - 6.0) / 12.0))
    clear = F.lit(1000.0) * elev * (F.lit(1.0) + F.lit(0.033) * F.cos(F.lit(2 * math.pi) * _c(doy) / 365.0))
    den = F.when(clear == 0, F.lit(1.0)).otherwise(clear)
    return F.when(_c(plant_type) == "solar", clip(_c(irr) / den, 0.0, 2.0))


def irradiance_temp_adjusted(irr="surface_solar_radiation_downwards", temp="temperature_2m",
                             plant_type="plant_type") -> Column:
    return F.when(_c(plant_type) == "solar", _c(irr) * (F.lit(1.0) - F.lit(0.005) * (_c(temp) - 25.0)))


def air_density(pressure="surface_pressure", temp="temperature_2m") -> Column:
    return _c(pressure) / (F.lit(C.GAS_CONSTANT_AIR) * (_c(temp) + F.lit(C.KELVIN)))


def wind_power_density(speed="wind_speed", pressure="surface_pressure", temp="temperature_2m",
                       plant_type="plant_type") -> Column:
    v = _c(speed)
    return F.when(_c(plant_type) == "wind", F.lit(0.5) * air_density(pressure, temp) * (v * v * v))


def wind_speed_category(speed="wind_speed", plant_type: str | Column | None = "plant_type") -> Column:
    """Right-closed bins (0,3] low ... (25,100] extreme; outside -> NULL."""
    v = _c(speed)
    expr = None
    for lo, hi, label in C.WIND_SPEED_BINS:
        cond = (v > F.lit(lo)) & (v <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if plant_type is None:
        return expr
    return F.when(_c(plant_type) == "wind", expr)



def capacity_factor(gen="generation_mw", cap="capacity_mw") -> Column:
    return F.try_divide(_c(gen), _c(cap))


def wind_vector(u="wind_u_component", v="wind_v_component") -> tuple[Column, Column]:
    """(speed, direction in degrees, math convention atan2(v, u))."""
    uu, vv = _c(u), _c(v)
    return F.sqrt(uu * uu + vv * vv), F.atan2(vv, uu) * F.lit(180.0) / F.lit(math.pi)


def kelvin_to_celsius(x) -> Column:
    return _c(x) - F.lit(C.KELVIN)


def pv_expected_power(irr="surface_solar_radiation_downwards", temp="temperature_2m",
                      cloud="total_cloud_cover", capacity="capacity_mw",
                      efficiency: float | Column = C.PV_EFFICIENCY,
                      area_m2_per_mw: float = 1000.0) -> Column:
    """Deterministic PV output in MW; the default area keeps the literal formula."""
    eff = efficiency if isinstance(efficiency, Column) else F.lit(float(efficiency))
    i = _c(irr)
    power = i * ((F.lit(100.0) - _c(cloud)) / 100.0) * eff * (F.lit(1.0) - F.lit(C.PV_TEMP_COEFF) * (_c(temp) - 25.0))
    mw = F.least(power / F.lit(1e6) * F.lit(area_m2_per_mw), _c(capacity))
    return F.when(i.isNull(), F.lit(None).cast("double")).when(i <= 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), mw))


def wind_power_curve(speed="wind_speed", rated="capacity_mw") -> Column:
    v, r = _c(speed), _c(rated)
    ci, rs, co = C.CUT_IN, C.RATED_SPEED, C.CUT_OUT
    ratio = (v * v * v - F.lit(ci ** 3)) / F.lit(rs ** 3 - ci ** 3)
    return (
        F.when(v.isNull(), F.lit(None).cast("double"))
        .when((v < ci) | (v > co), F.lit(0.0))
        .when(v <= rs, r * ratio)
        .otherwise(r)
    )


def default_coalesce(df_columns, alternatives: list[str], default: float) -> Column:
    """First present, non-null column among ``alternatives``, else ``default``."""
    present = [F.col(a) for a in alternatives if a in df_columns]
    return F.coalesce(*present, F.lit(float(default)))

"""Feature construction on the aligned hourly grid.

Lags and rolling statistics run as one halo-window pass
(:func:`halo_window`): all 67 window columns share one partitioning
``(plant, time bucket)`` and one sort, so Catalyst plans a single Window
operator after a single shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline import config as C
from wattline.functions import physics as P
from wattline.functions.calendar import add_calendar_features
from wattline.operators.windows import halo_window


def lag_columns(w: Window, cols: Sequence[str], lags: Sequence[int]) -> list[Column]:
    return [F.lag(c, n).over(w).alias(f"{c}_lag_{n}h") for n in lags for c in cols]


def rolling_columns(w: Window, col: str, windows: Sequence[int], stats=("mean", "std", "min", "max")) -> list[Column]:
    out = []
    fns = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    for n in windows:
        frame = w.rowsBetween(-(n - 1), Window.currentRow)
        for s in stats:
            out.append(fns[s](col).over(frame).alias(f"{col}_roll_{s}_{n}h"))
    return out


def feature_window_columns(w: Window, df_cols: Sequence[str], target: str = "generation_mw",
                           lags: Sequence[int] = C.LAGS, windows: Sequence[int] = C.ROLLING_WINDOWS,
                           weather: Sequence[str] = C.KEY_WEATHER_COLS) -> list[Column]:
    """Lag and rolling columns in the reference column order."""
    wcols = [c for c in weather if c in df_cols]
    cols = []
    for n in lags:
        if target in df_cols:
            cols += lag_columns(w, [target], [n])
        cols += lag_columns(w, wcols, [n])
    for n in windows:
        if target in df_cols:
            cols += rolling_columns(w, target, [n])
        for c in wcols:
            cols += rolling_columns(w, c, [n], ("mean",))
    return cols


def add_window_features(df: DataFrame, keys: Sequence[str] = ("plant_name",), ts: str = "timestamp",
                        target: str = "generation_mw", lags: Sequence[int] = C.LAGS,
                        windows: Sequence[int] = C.ROLLING_WINDOWS,
                        weather: Sequence[str] = C.KEY_WEATHER_COLS,
                        bucket_hours: int = C.Defaults().halo_bucket_hours) -> DataFrame:
    """All lags + rolling stats in one halo pass (input: regular hourly grid)."""
    back = max([*lags, *[n - 1 for n in windows], 0])
    cols = df.columns
    return halo_window(df, keys, ts, lambda w: feature_window_columns(w, cols, target, lags, windows, weather),
                       back=back, bucket_hours=bucket_hours)


def add_lag_features(df, cols, lags=C.LAGS, keys=("plant_name",), ts="timestamp",
                     bucket_hours: int = C.Defaults().halo_bucket_hours) -> DataFrame:
    cols = [c for c in cols if c in df.columns]
    return halo_window(df, keys, ts, lambda w: lag_columns(w, cols, lags), back=max(lags), bucket_hours=bucket_hours)


def add_rolling_features(df, cols: dict[str, Sequence[str]], windows=C.ROLLING_WINDOWS, keys=("plant_name",),
                         ts="timestamp", bucket_hours: int = C.Defaults().halo_bucket_hours) -> DataFrame:
    """``cols`` maps column -> statistics (subset of mean/std/min/max)."""
    def build(w):
        out = []
        for c, stats in cols.items():
            out += rolling_columns(w, c, windows, stats)
        return out
    return halo_window(df, keys, ts, build, back=max(windows) - 1, bucket_hours=bucket_hours)


def domain_columns(df_cols: Sequence[str], target: str = "generation_mw") -> dict[str, Column]:
    """clear-sky index, temperature-adjusted irradiance (solar), wind power
    density and speed class (wind), capacity factor — guarded by presence."""
    out: dict[str, Column] = {}
    irr, temp, ws, sp = ("surface_solar_radiation_downwards", "temperature_2m", "wind_speed", "surface_pressure")
    if irr in df_cols:
        out["clear_sky_index"] = P.clear_sky_index()
        if temp in df_cols:
            out["irradiance_temp_adjusted"] = P.irradiance_temp_adjusted()
    if ws in df_cols and sp in df_cols and temp in df_cols:
        out["wind_power_density"] = P.wind_power_density()
    if ws in df_cols:
        out["wind_speed_category"] = P.wind_speed_category()
    if "capacity_mw" in df_cols and target in df_cols:
        out["capacity_factor"] = P.capacity_factor(target)
    return out


def add_domain_features(df: DataFrame, target: str = "generation_mw") -> DataFrame:
    return df.withColumns(domain_columns(df.columns, target))


def clip_columns(df_cols: Sequence[str], target: str = "generation_mw") -> dict[str, Column]:
    out = {}
    if target in df_cols and "capacity_mw" in df_cols:
        out[target] = P.clip(target, 0.0, F.col("capacity_mw") * F.lit(C.OVERGEN_FACTOR))
    for c, (lo, hi) in C.CLIP_RANGES.items():
        if c in df_cols:
            out[c] = P.clip(c, lo, hi)
    return out


def clip_physical(df: DataFrame, target: str = "generation_mw") -> DataFrame:
    """Generation to [0, 1.1 x capacity]; temperature, wind, irradiance ranges."""
    return df.withColumns(clip_columns(df.columns, target))


META_COLS = ("event_id", "timestamp", "plant_name", "plant_type", "capacity_mw", "latitude", "longitude")


def select_features(df: DataFrame, target: str = "generation_mw", keep_target_history: bool = False,
                    exclude: Sequence[str] = ("capacity_factor",)) -> DataFrame:
    """Model inputs: drop id/meta/target columns, the ``target`` prefix
    (unless ``keep_target_history``) and leaking columns."""
    keep = []
    for c in df.columns:
        if c in META_COLS or c == target or c in exclude:
            continue
        if not keep_target_history and c.startswith(target):
            continue
        keep.append(c)
    return df.select(*keep)


def lookback_sequences(df: DataFrame, feature_cols: Sequence[str], length: int = 24,
                       keys: Sequence[str] = ("plant_name",), ts: str = "timestamp", target: str = "generation_mw",
                       bucket_hours: int = C.Defaults().halo_bucket_hours) -> DataFrame:
    """For each row the previous ``length`` feature vectors (oldest first)
    and its target; rows without ``length`` predecessors are dropped."""
    def build(w):
        frame = w.rowsBetween(-length, -1)
        return [F.collect_list(F.array(*[F.col(c).cast("double") for c in feature_cols])).over(frame).alias("window")]
    out = halo_window(df, keys, ts, build, back=length, bucket_hours=bucket_hours)
    return out.filter(F.size("window") == length).select(*keys, ts, "window", F.col(target).alias("target"))


def build_features(aligned: DataFrame, keys: Sequence[str] = ("plant_name",), ts: str = "timestamp",
                   target: str = "generation_mw", clip_first: bool = False,
                   bucket_hours: int = C.Defaults().halo_bucket_hours) -> DataFrame:
    """calendar -> lags -> rolling -> domain -> clip (clip last by default)."""
    df = aligned
    if clip_first:
        df = clip_physical(df, target)
    df = add_calendar_features(df, ts)
    df = add_window_features(df, keys, ts, target, bucket_hours=bucket_hours)
    df = add_domain_features(df, target)
    if not clip_first:
        df = clip_physical(df, target)
    return df

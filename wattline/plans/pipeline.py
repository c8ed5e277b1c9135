"""End-to-end plans composed from the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from wattline import config as C
from wattline.operators.align import align_time_series
from wattline.operators.features import build_features
from wattline.operators.joins import merge_weather
from wattline.operators.repair import repair_missing


def pipeline_features(
    generation: DataFrame,
    weather: DataFrame,
    plant_filter: Sequence[str] | None = None,
    keys: Sequence[str] = ("plant_name",),
    ts: str = "timestamp",
    tiebreak: Sequence[str] = (),
    defaults: C.Defaults = C.DEFAULTS,
    clip_first: bool = False,
) -> DataFrame:
    """load -> nearest-time weather merge -> repair -> hourly alignment ->
    calendar / lag / rolling / domain features -> physical clipping.

    One lazy plan; order the output at the sink (``orderBy(ts, plant)``).
    """
    wcols = [c for c in defaults.weather_cols if c in weather.columns]
    merged = merge_weather(generation, weather, wcols, ts, plant_filter)
    repaired = repair_missing(merged, wcols, keys=keys, ts=ts, tiebreak=tiebreak,
                              limit=defaults.max_gap_rows, fill_limit=defaults.fill_limit_rows,
                              bucket_hours=defaults.carry_bucket_hours)
    aligned = align_time_series(repaired, keys, ts, wcols, limit=defaults.max_gap_rows, tiebreak=tiebreak,
                                bucket_hours=defaults.carry_bucket_hours)
    return build_features(aligned, keys, ts, clip_first=clip_first, bucket_hours=defaults.halo_bucket_hours)

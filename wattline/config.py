"""Defaults for the pipeline.

The values marked FIXED must equal the behaviour being reproduced (lag
lists, window lengths, physical ranges, thresholds); everything else is a
tuning knob for Spark execution.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (domain constants that define results)
# ---------------------------------------------------------------------------
LAGS = (1, 2, 3, 6, 12, 24, 48, 168)
ROLLING_WINDOWS = (3, 6, 12, 24, 168)
WEATHER_COLS = (
    "temperature_2m",
    "wind_speed",
    "surface_solar_radiation_downwards",
    "total_cloud_cover",
    "total_precipitation",
    "surface_pressure",
)
KEY_WEATHER_COLS = ("temperature_2m", "wind_speed", "surface_solar_radiation_downwards")
WEATHER_RANGES = {
    "temperature_2m": (-50.0, 60.0),
    "wind_speed": (0.0, 50.0),
    "surface_solar_radiation_downwards": (0.0, 1500.0),
    "total_cloud_cover": (0.0, 100.0),
    "total_precipitation": (0.0, 500.0),
}
CLIP_RANGES = {
    "temperature_2m": (-10.0, 60.0),
    "wind_speed": (0.0, 50.0),
    "surface_solar_radiation_downwards": (0.0, 1500.0),
}
OVERGEN_FACTOR = 1.1
MAX_GAP_ROWS = 6          # interpolation limit
FILL_LIMIT_ROWS = 24      # ffill / bfill limit
MAX_MISSING_PCT = 5.0
MIN_DATA_POINTS = 1000
GAP_SHARE = 0.01
SOLAR_CORR_MIN = 0.3
WIND_CORR_MIN = 0.5
DAYLIGHT_HOURS = (6, 18)
# right-closed wind-speed classes: (lower, upper, label)
WIND_SPEED_BINS = (
    (0.0, 3.0, "low"),
    (3.0, 8.0, "moderate"),
    (8.0, 12.0, "high"),
    (12.0, 25.0, "very_high"),
    (25.0, 100.0, "extreme"),
)
QUANTILES = (0.1, 0.5, 0.9)
PICP_TARGET = 0.8
CWC_ETA = 10.0
RELIABLE_PICP = 0.75
Z80 = 1.2816              # standard-normal quantile for an 80 % central interval
CONFIDENCE_HIGH = 0.1
CONFIDENCE_MEDIUM = 0.2
DEFAULT_CAPACITY = 100.0
INTERVAL_FALLBACK = (0.9, 1.1)
SERVING_FALLBACK = (0.8, 1.2)
GAS_CONSTANT_AIR = 287.05
KELVIN = 273.15
# Region box (degrees)
BBOX = {"north": 18.5, "south": 11.5, "east": 78.5, "west": 74.0}
# request-side defaults for absent weather inputs
WEATHER_DEFAULTS = {
    "surface_solar_radiation_downwards": 800.0,
    "temperature_2m": 25.0,
    "total_cloud_cover": 30.0,
    "wind_speed": 5.0,
}
# weather-service parameters (payload flattening)
SERVICE_PARAMETERS = (
    "ALLSKY_SFC_SW_DWN",
    "CLRSKY_SFC_SW_DWN",
    "T2M",
    "RH2M",
    "WS2M",
    "WD2M",
    "PRECTOTCORR",
    "PS",
)
# reanalysis short names -> pipeline names
GRID_RENAMES = {
    "t2m": "temperature_2m",
    "d2m": "dewpoint_2m",
    "sp": "surface_pressure",
    "tp": "total_precipitation",
    "ssrd": "surface_solar_radiation_downwards",
    "tcc": "total_cloud_cover",
    "u10": "wind_u_component",
    "v10": "wind_v_component",
}
# wind turbine curve (m/s)
CUT_IN, RATED_SPEED, CUT_OUT = 3.0, 12.0, 25.0
PV_EFFICIENCY = 0.22
PV_TEMP_COEFF = 0.004


@dataclass(frozen=True)
class Defaults:
    """Execution knobs plus the fixed lists above, overridable per call."""

    lags: tuple = LAGS
    rolling_windows: tuple = ROLLING_WINDOWS
    weather_cols: tuple = WEATHER_COLS
    key_weather_cols: tuple = KEY_WEATHER_COLS
    max_gap_rows: int = MAX_GAP_ROWS
    fill_limit_rows: int = FILL_LIMIT_ROWS
    # Time-bucket length for the bounded (halo) windows. Must be >= the
    # largest look-back / look-ahead in rows on the hourly grid.
    halo_bucket_hours: int = 720
    # Time-bucket length for unbounded carries (interpolation, as-of).
    carry_bucket_hours: int = 720
    quantiles: tuple = QUANTILES
    extra: dict = field(default_factory=dict)


DEFAULTS = Defaults()

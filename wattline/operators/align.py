"""Hourly alignment: resample per plant, spine, re-interpolate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline import config as C
from wattline.operators.joins import hourly_spine
from wattline.operators.repair import _interp
from wattline.operators.windows import carry_valid, drop_carry

STATIC_COLS = ("capacity_mw", "plant_type", "latitude", "longitude")


def _hour(ts: str):
    return F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")


def resample_hourly(
    df: DataFrame,
    keys: Sequence[str] = ("plant_name",),
    ts: str = "timestamp",
    mean_cols: Sequence[str] = ("generation_mw", *C.WEATHER_COLS),
    first_cols: Sequence[str] = STATIC_COLS,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Per key and hour: mean of ``mean_cols``, first non-null of ``first_cols``.

    "First" = value of the earliest row (``ts``, then ``tiebreak``) where it
    is not null: the minimum of ``struct(ts, tiebreak, value)`` over non-null
    values, deterministic and partially aggregated map-side.
    """
    aggs = [F.avg(c).alias(c) for c in mean_cols if c in df.columns]
    for c in first_cols:
        if c in df.columns:
            packed = F.when(F.col(c).isNotNull(), F.struct(F.col(ts), *[F.col(t) for t in tiebreak], F.col(c).alias("_v")))
            aggs.append(F.min(packed)["_v"].alias(c))
    return df.groupBy(*keys, _hour(ts).alias(ts)).agg(*aggs)


def static_attributes(df: DataFrame, keys: Sequence[str] = ("plant_name",), ts: str = "timestamp",
                      cols: Sequence[str] = STATIC_COLS, tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per key: first non-null value of each static attribute."""
    aggs = []
    for c in cols:
        if c in df.columns:
            packed = F.when(F.col(c).isNotNull(), F.struct(F.col(ts), *[F.col(t) for t in tiebreak], F.col(c).alias("_v")))
            aggs.append(F.min(packed)["_v"].alias(c))
    return df.groupBy(*keys).agg(*aggs)


def align_time_series(
    df: DataFrame,
    keys: Sequence[str] = ("plant_name",),
    ts: str = "timestamp",
    weather_cols: Sequence[str] = C.WEATHER_COLS,
    target: str = "generation_mw",
    limit: int = C.MAX_GAP_ROWS,
    tiebreak: Sequence[str] = (),
    bucket_hours: int = C.Defaults().carry_bucket_hours,
) -> DataFrame:
    """Regular hourly grid per plant from its first to its last hour.

    Bins without data become rows; numeric series are interpolated in time
    (limit ``limit``).  Static attributes (capacity, type, coordinates) of
    gap rows are the key's first known ones, so gap rows keep their plant type.  Everything after the
    hourly aggregate runs on ``(plant, time bucket)`` partitions: no task
    ever holds a whole plant.
    """
    mean_cols = [c for c in (target, *weather_cols) if c in df.columns]
    statics = [c for c in STATIC_COLS if c in df.columns]
    hourly = resample_hourly(df, keys, ts, mean_cols, statics, tiebreak)
    # bounds from the (smaller) hourly aggregate; its shuffle is reused
    spine = hourly_spine(hourly, keys, ts)
    grid = spine.join(hourly, on=[*keys, ts], how="left")
    carried = carry_valid(grid, keys, ts, {c: c for c in mean_cols}, bucket_hours=bucket_hours)
    out = drop_carry(carried.withColumns({c: _interp(c, ts, limit, "time") for c in mean_cols}))
    if statics:  # one row per key
        known = static_attributes(hourly, keys, ts, statics).withColumnsRenamed({c: f"_s_{c}" for c in statics})
        out = out.join(known, on=list(keys), how="left").withColumns({c: F.coalesce(c, f"_s_{c}") for c in statics})
    order = [*keys, ts, target, *statics, *[c for c in weather_cols if c in mean_cols]]
    return out.select(*[c for c in order if c in out.columns])

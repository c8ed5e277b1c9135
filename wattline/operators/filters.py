"""Projections and predicates (all pushed to the Parquet scan where possible)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline import config as C


def filter_plants(df: DataFrame, plants: Sequence[str] | None, col: str = "plant_name") -> DataFrame:
    """Keep listed plants; ``None``/empty means no filter."""
    return df.filter(F.col(col).isin(list(plants))) if plants else df


def filter_plant_eq(df: DataFrame, plant: str, col: str = "plant_name") -> DataFrame:
    return df.filter(F.col(col) == plant)


def filter_bbox(df: DataFrame, bbox: dict = C.BBOX, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.filter(F.col(lat).between(bbox["south"], bbox["north"]) & F.col(lon).between(bbox["west"], bbox["east"]))


def filter_date_range(df: DataFrame, start: str | None, end: str | None, ts: str = "timestamp") -> DataFrame:
    """Inclusive start date, exclusive day after ``end`` (whole days)."""
    cond = F.lit(True)
    if start:
        cond = cond & (F.col(ts) >= F.to_timestamp_ntz(F.lit(start)))
    if end:
        cond = cond & (F.col(ts) < F.to_timestamp_ntz(F.lit(end)) + F.expr("INTERVAL 1 DAY"))
    return df.filter(cond)


def mask_type(value: Column, plant_type: str, type_col: str = "plant_type") -> Column:
    """``value`` on rows of the given plant type, else NULL."""
    return F.when(F.col(type_col) == plant_type, value)


def filter_daylight(df: DataFrame, hours=C.DAYLIGHT_HOURS, ts: str = "timestamp",
                    type_col: str = "plant_type") -> DataFrame:
    h = F.col("hour") if "hour" in df.columns else F.hour(ts)
    return df.filter((F.col(type_col) == "solar") & h.between(*hours))


def rename_columns(df: DataFrame, mapping: dict = C.GRID_RENAMES) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def add_location_literal(df: DataFrame, name: str, lat: float | None = None, lon: float | None = None) -> DataFrame:
    cols = {"location": F.lit(name)}
    if lat is not None:
        cols["latitude"] = F.lit(float(lat))
    if lon is not None:
        cols["longitude"] = F.lit(float(lon))
    return df.withColumns(cols)


def validate_requests(df: DataFrame, required: Sequence[str] = (
        "temperature_2m", "wind_speed", "surface_solar_radiation_downwards", "total_cloud_cover",
        "total_precipitation", "hour", "month", "plant_type")) -> DataFrame:
    """``is_valid``: hour in 0..23, month in 1..12, required fields present;
    ``reason`` names the first failed rule."""
    missing = None
    for c in required:
        cond = F.col(c).isNull()
        missing = F.when(cond, F.lit(f"missing:{c}")) if missing is None else missing.when(cond, F.lit(f"missing:{c}"))
    reason = missing.when(~F.col("hour").between(0, 23), F.lit("hour_out_of_range")) \
        .when(~F.col("month").between(1, 12), F.lit("month_out_of_range"))
    return df.withColumn("reason", reason).withColumn("is_valid", F.col("reason").isNull())

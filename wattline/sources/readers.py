"""Readers with fixed schemas (CSV / Parquet / JSON payloads)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import config as C
from wattline.functions.physics import kelvin_to_celsius, wind_vector
from wattline.schema import GENERATION_SCHEMA, SERVICE_PAYLOAD_SCHEMA, weather_schema
from wattline.sources.sinks import MONTH

TIME_KEYS = ("timestamp", "time", "date")


def _reader(spark: SparkSession, fmt: str, schema):
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
    if schema is not None and fmt in ("csv", "json"):
        r = r.schema(schema)
    return r


def read_generation(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Generation facts; CSV is read with the fixed schema (no inference)."""
    return _reader(spark, fmt, GENERATION_SCHEMA).load(path)


def normalize_time_key(df: DataFrame, out: str = "timestamp") -> DataFrame:
    """Accept ``time`` / ``date`` / ``timestamp`` as the time key."""
    present = [k for k in TIME_KEYS if k in df.columns]
    if not present:
        raise ValueError("no time column among " + ", ".join(TIME_KEYS))
    key = present[0]
    col = F.col(key)
    if dict(df.dtypes)[key] in ("string", "date"):
        col = F.to_timestamp_ntz(col.cast("string"))
    rest = [c for c in df.columns if c not in present]
    return df.select(col.cast("timestamp_ntz").alias(out), *rest)


def read_weather(spark: SparkSession, path: str, fmt: str = "parquet", time_key: str = "timestamp") -> DataFrame:
    return normalize_time_key(_reader(spark, fmt, weather_schema(time_key)).load(path))


def read_features(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Re-read the feature table; Catalyst prunes to ``columns``. No global sort."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df.drop(MONTH)


def flatten_service_payload(df: DataFrame, payload: str = "payload",
                            keys: Sequence[str] = ("location",),
                            parameters: Sequence[str] = C.SERVICE_PARAMETERS) -> DataFrame:
    """``{"properties":{"parameter":{P:{"yyyyMMdd": v}}}}`` -> one row per
    (keys, date) and one column per parameter (missing -> NULL)."""
    parsed = df.select(*keys, F.from_json(F.col(payload), SERVICE_PAYLOAD_SCHEMA).alias("_p"))
    by_param = parsed.select(*keys, F.explode(F.col("_p.properties.parameter")).alias("_param", "_series"))
    cells = by_param.select(*keys, "_param", F.explode("_series").alias("_day", "_value"))
    wide = (cells.groupBy(*keys, "_day").pivot("_param", list(parameters)).agg(F.first("_value")))
    return wide.select(*keys, F.to_date("_day", "yyyyMMdd").alias("date"), *parameters)


def tidy_grid(df: DataFrame, location: str | None = None, renames: dict = C.GRID_RENAMES) -> DataFrame:
    """Flattened reanalysis grid -> pipeline convention (one ``select``)."""
    speed, direction = wind_vector("u10", "v10")
    cols = [F.col(c) for c in df.columns if c not in renames]
    cols += [speed.alias("wind_speed"), direction.alias("wind_direction")]
    for short, long in renames.items():
        if short in df.columns:
            c = F.col(short)
            if short in ("t2m", "d2m"):
                c = kelvin_to_celsius(c)
            cols.append(c.alias(long))
    if location is not None:
        cols.append(F.lit(location).alias("location"))
    return df.select(*cols)

"""Fixed schemas at the edges (reads, requests, prediction / metric tables)."""

from __future__ import annotations

from pyspark.sql import types as T

D = T.DoubleType()

GENERATION_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("plant_name", T.StringType()),
        T.StructField("plant_type", T.StringType()),
        T.StructField("capacity_mw", D),
        T.StructField("generation_mw", D),
        T.StructField("capacity_factor", D),
        T.StructField("latitude", D),
        T.StructField("longitude", D),
    ]
)

WEATHER_FIELDS = [
    ("location", T.StringType()),
    ("latitude", D),
    ("longitude", D),
    ("temperature_2m", D),
    ("dewpoint_2m", D),
    ("surface_pressure", D),
    ("total_precipitation", D),
    ("surface_solar_radiation_downwards", D),
    ("total_cloud_cover", D),
    ("wind_u_component", D),
    ("wind_v_component", D),
    ("wind_speed", D),
    ("wind_direction", D),
]


def weather_schema(time_key: str = "timestamp") -> T.StructType:
    return T.StructType(
        [T.StructField(time_key, T.TimestampNTZType())]
        + [T.StructField(n, t) for n, t in WEATHER_FIELDS]
    )


PLANT_DIM_SCHEMA = T.StructType(
    [
        T.StructField("plant_name", T.StringType(), False),
        T.StructField("plant_type", T.StringType(), False),
        T.StructField("capacity_mw", D, False),
        T.StructField("latitude", D, False),
        T.StructField("longitude", D, False),
        T.StructField("commission_date", T.DateType(), True),
    ]
)

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("temperature_2m", D),
        T.StructField("wind_speed", D),
        T.StructField("surface_solar_radiation_downwards", D),
        T.StructField("total_cloud_cover", D),
        T.StructField("total_precipitation", D),
        T.StructField("hour", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("plant_type", T.StringType()),
        T.StructField("model", T.StringType()),
    ]
)

PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("plant_name", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("y_true", D),
        T.StructField("P10", D),
        T.StructField("P50", D),
        T.StructField("P90", D),
    ]
)

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("plant_name", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", D),
    ]
)

SERVICE_PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField(
            "properties",
            T.StructType(
                [T.StructField("parameter", T.MapType(T.StringType(), T.MapType(T.StringType(), D)))]
            ),
        )
    ]
)

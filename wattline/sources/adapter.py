"""Test adapter: derive generation / weather / plant tables from ``events``.

The driver supplies generic tables; this module maps ``events`` onto the
domain schemas (see FIXTURES.md).  The mapping deliberately injects nulls,
negatives, over-generation, out-of-range irradiance and missing hours so the
repair and quality operators have work to do.  Everything is a projection of
``events`` joined to the plant dimension of seven rows (broadcast: fixed size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Invented test plants (pid, name, type, capacity MW, lat, lon): sun and wind
# alternate, sizes and places are arbitrary.
ADAPTER_PLANTS = (
    (0, "solar_a", "solar", 120.0, 40.25, -3.5),
    (1, "wind_a", "wind", 64.0, 41.75, -1.25),
    (2, "solar_b", "solar", 36.0, 38.5, -4.0),
    (3, "wind_b", "wind", 210.0, 43.25, -7.75),
    (4, "solar_c", "solar", 260.0, 37.75, -5.25),
    (5, "wind_c", "wind", 44.0, 39.5, -2.5),
    (6, "solar_d", "solar", 90.0, 36.75, -6.0),
)
N_SITES = 4

PLANT_SCHEMA = T.StructType(
    [
        T.StructField("pid", T.LongType(), False),
        T.StructField("plant_name", T.StringType(), False),
        T.StructField("plant_type", T.StringType(), False),
        T.StructField("capacity_mw", T.DoubleType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
    ]
)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def adapter_plants(spark: SparkSession) -> DataFrame:
    """The adapter's plant dimension (7 rows) with its weather site."""
    return spark.createDataFrame(list(ADAPTER_PLANTS), PLANT_SCHEMA).withColumn(
        "location", F.concat(F.lit("site_"), (F.col("pid") % N_SITES).cast("string"))
    )


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("double")


def generation_from_events(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Generation facts: one row per non-view event, plant = user_id mod 7."""
    plants = F.broadcast(adapter_plants(spark).drop("location"))
    ev = events.filter(F.col("event_type") != "view")
    j = ev.join(plants, (F.col("user_id") % F.lit(len(ADAPTER_PLANTS))) == F.col("pid"))
    gen = (
        F.when(F.col("event_id") % 23 == 0, F.lit(None).cast("double"))
        .when(F.col("event_id") % 97 == 0, F.lit(-1.0))
        .otherwise(F.col("value") * F.col("capacity_mw") / F.lit(200.0))
    )
    return j.select(
        F.col("ts").alias("timestamp"),
        "event_id",
        "plant_name",
        "plant_type",
        "capacity_mw",
        gen.alias("generation_mw"),
        "latitude",
        "longitude",
    )


def weather_from_events(events: DataFrame) -> DataFrame:
    """Hourly weather rows at 4 sites: one row per view event."""
    k = _k()
    ev = events.filter(F.col("event_type") == "view")
    return ev.select(
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("timestamp"),
        F.concat(F.lit("site_"), (F.col("user_id") % N_SITES).cast("string")).alias("location"),
        F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("double"))
        .otherwise(F.lit(10.0) + k * F.lit(0.5))
        .alias("temperature_2m"),
        (F.col("user_id") % 30).cast("double").alias("wind_speed"),
        (F.col("value") * F.lit(6.0)).alias("surface_solar_radiation_downwards"),
        k.alias("total_cloud_cover"),
        (F.col("value") / F.lit(100.0)).alias("total_precipitation"),
        (F.lit(95000.0) + k * F.lit(50.0)).alias("surface_pressure"),
    )


def adapter_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = load_table(spark, sf_dir, "events")
    return generation_from_events(spark, events), weather_from_events(events)

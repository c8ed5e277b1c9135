"""Readers / sinks round trips and column pruning."""

import datetime as dt
import json
import tempfile

from pyspark.sql import functions as F

from wattline.sources.readers import flatten_service_payload, normalize_time_key, read_features, read_generation
from wattline.sources.sinks import write_features, write_partitioned


def test_csv_generation_fixed_schema(spark):
    d = tempfile.mkdtemp(prefix="wl-csv-")
    with open(f"{d}/g.csv", "w") as f:
        f.write("timestamp,plant_name,plant_type,capacity_mw,generation_mw,capacity_factor,latitude,longitude\n")
        f.write("2024-01-01 00:00:00,a,solar,10,5.5,0.55,12.0,77.0\n")
        f.write("2024-01-01 01:00:00,a,solar,10,,,12.0,77.0\n")
    df = read_generation(spark, f"{d}/g.csv", fmt="csv")
    assert dict(df.dtypes)["timestamp"] == "timestamp_ntz"
    rows = df.orderBy("timestamp").collect()
    assert rows[0]["generation_mw"] == 5.5 and rows[1]["generation_mw"] is None


def test_time_key_normalised(spark):
    df = spark.createDataFrame([("2024-01-02 03:00:00", 1.0)], "time string, t double")
    out = normalize_time_key(df)
    assert out.columns[0] == "timestamp" and out.first()[0] == dt.datetime(2024, 1, 2, 3)


def test_payload_flatten(spark):
    doc = {"properties": {"parameter": {"T2M": {"20240101": 24.1, "20240102": 25.0}, "WS2M": {"20240101": 3.0}}}}
    df = spark.createDataFrame([("x", json.dumps(doc))], "location string, payload string")
    rows = {r["date"]: r for r in flatten_service_payload(df).collect()}
    assert rows[dt.date(2024, 1, 1)]["T2M"] == 24.1 and rows[dt.date(2024, 1, 1)]["WS2M"] == 3.0
    assert rows[dt.date(2024, 1, 2)]["WS2M"] is None and rows[dt.date(2024, 1, 2)]["PS"] is None


def test_feature_sink_and_pruned_scan(spark):
    d = tempfile.mkdtemp(prefix="wl-feat-")
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, h), float(h), 1.0) for h in range(5)],
                               "plant_name string, timestamp timestamp_ntz, x double, y double")
    write_features(df, f"{d}/f")
    back = read_features(spark, f"{d}/f", ["timestamp", "x"]).filter(F.col("x") > 2)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<timestamp:timestamp_ntz,x:double>" in plan
    assert "PushedFilters" in plan and back.count() == 2
    write_partitioned(df.withColumn("plant_type", F.lit("solar")), f"{d}/p")
    assert spark.read.parquet(f"{d}/p").filter("plant_name = 'a'").count() == 5

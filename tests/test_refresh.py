"""A refreshed feature table equals a rebuilt one, and only changed folders are written."""

import datetime as dt
import glob
import math
import os
import random

from pyspark.sql import functions as F

from wattline.plans.pipeline import pipeline_features
from wattline.plans.refresh import refresh_features
from wattline.sources.sinks import write_features

T0 = dt.datetime(2024, 1, 1)


def stamps(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/plant_name=*/year_month=*/part-*")}


def folders(files):
    return {tuple(p.split("=")[1] for p in f.split("/")[-3:-1]) for f in files}


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


def test_only_touched_months_are_written(spark, tmp_path):
    rnd = random.Random(1)
    rows, n = [], 0
    for p, kind in (("a", "solar"), ("b", "wind")):
        for h in range(0, 24 * 100, 1):  # January to April
            if rnd.random() < 0.8:
                n += 1
                rows.append((T0 + dt.timedelta(hours=h, minutes=rnd.randint(0, 59)), n, p, kind, 50.0, None if rnd.random() < 0.03 else rnd.random() * 40, 40.0, -3.0))
    schema = "timestamp timestamp_ntz, event_id long, plant_name string, plant_type string, capacity_mw double, generation_mw double, latitude double, longitude double"
    gen = spark.createDataFrame(rows, schema)
    weather = [(T0 + dt.timedelta(hours=h), float(h % 24), float(h % 17), float(h % 24 * 30), float(h % 9), 0.0, 95000.0 + h) for h in range(0, 24 * 100, 2)]
    wea = spark.createDataFrame(weather, "timestamp timestamp_ntz, temperature_2m double, wind_speed double, surface_solar_radiation_downwards double, "
                                         "total_cloud_cover double, total_precipitation double, surface_pressure double")
    # late: some hours of plant a in the middle of February (their lags stay inside it), and the last hour of March
    when = F.col("timestamp")
    late = gen.filter((F.col("plant_name") == "a") & (when.between(F.lit(dt.datetime(2024, 2, 10)), F.lit(dt.datetime(2024, 2, 10, 9)))
                                                      | when.between(F.lit(dt.datetime(2024, 3, 31, 20)), F.lit(dt.datetime(2024, 3, 31, 23, 59)))))
    assert late.count() > 5
    path, whole = str(tmp_path / "table"), str(tmp_path / "whole")
    write_features(pipeline_features(gen.join(late.select("event_id"), "event_id", "left_anti"), wea, tiebreak=("event_id",)), path)
    before = stamps(path)
    changed = refresh_features(path, gen, wea, late, tiebreak=("event_id",))
    after = stamps(path)
    assert {(r[0], r[1]) for r in changed.collect()} == {("a", "2024-02"), ("a", "2024-03"), ("a", "2024-04")}  # April holds lags of March
    kept = {f for f in after if before.get(f) == after[f]}
    assert folders(set(after) - kept) == {("a", "2024-02"), ("a", "2024-03"), ("a", "2024-04")}
    assert folders(kept) == {("a", "2024-01")} | {("b", f"2024-0{m}") for m in (1, 2, 3, 4)}
    write_features(pipeline_features(gen, wea, tiebreak=("event_id",)), whole)
    read = lambda p: spark.read.parquet(p).orderBy("plant_name", "timestamp").collect()
    got, want = read(path), read(whole)
    assert len(got) == len(want) and all(same(a[c], b[c]) for a, b in zip(got, want) for c in want[0].asDict())
    # the same readings again change nothing
    assert refresh_features(path, gen, wea, late, tiebreak=("event_id",)).count() == 0
    assert stamps(path) == after

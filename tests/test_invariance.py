"""Bucket sizes and partition counts must not change results."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from wattline import config as C
from wattline.operators.align import align_time_series
from wattline.operators.features import build_features
from wattline.operators.joins import asof_join, aggregate_weather_by_time
from wattline.operators.repair import repair_missing
from wattline.sources.adapter import adapter_tables


def _pipeline(spark, carry_hours, halo_hours, asof_seconds):
    gen, wea = adapter_tables(spark, SF_SMALL)
    w = list(C.WEATHER_COLS)
    merged = asof_join(gen, aggregate_weather_by_time(wea, w), bucket_seconds=asof_seconds)
    rep = repair_missing(merged, w, tiebreak=("event_id",), bucket_hours=carry_hours)
    al = align_time_series(rep, tiebreak=("event_id",), bucket_hours=carry_hours)
    return build_features(al, bucket_hours=halo_hours)


def _canon(df):
    cols = sorted(df.columns)
    out = df.select(*[F.round(F.col(c), 9).alias(c) if t == "double" else F.col(c) for c, t in df.select(*cols).dtypes])
    return sorted(tuple(repr(x) for x in r) for r in out.collect())


def test_pipeline_independent_of_buckets_and_partitions(spark):
    base = _canon(_pipeline(spark, 720, 720, 3600))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        small = _canon(_pipeline(spark, 48, 170, 900))
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        other = _canon(_pipeline(spark, 200, 400, 86400))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(base) > 1000
    assert base == small == other


def test_repair_unchanged_under_input_repartitioning(spark):
    gen, wea = adapter_tables(spark, SF_SMALL)
    w = list(C.WEATHER_COLS)
    merged = asof_join(gen, aggregate_weather_by_time(wea, w))
    results = []
    for n in (1, 7, 64):
        rep = repair_missing(merged.repartition(n), w, tiebreak=("event_id",), bucket_hours=48)
        results.append(_canon(rep))
    assert results[0] == results[1] == results[2]


def test_clip_is_idempotent(spark):
    from wattline.operators.features import clip_physical
    gen, wea = adapter_tables(spark, SF_SMALL)
    m = asof_join(gen, aggregate_weather_by_time(wea, list(C.WEATHER_COLS)))
    once = clip_physical(m)
    assert _canon(once) == _canon(clip_physical(once))
    assert once.filter((F.col("generation_mw") < 0) | (F.col("temperature_2m") > 60)).count() == 0

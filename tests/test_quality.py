"""Quality checks on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattline.operators import quality as Q

SCHEMA = "timestamp timestamp_ntz, plant_name string, plant_type string, generation_mw double, capacity_mw double"


def _df(spark):
    t = [dt.datetime(2024, 1, 1, h) for h in (0, 1, 1, 5)]
    rows = [(t[0], "a", "solar", -1.0, 10.0), (t[1], "a", "solar", 12.0, 10.0), (t[2], "a", "solar", None, 10.0),
            (t[3], "a", "solar", 5.0, 10.0)]
    return spark.createDataFrame(rows, SCHEMA)


def test_basic_checks(spark):
    df = _df(spark)
    assert Q.duplicate_keys(df).first()[0] == 1
    gb = Q.generation_bounds(df).first()
    assert (gb["negative_count"], gb["over_capacity_count"]) == (1, 1)
    gs = Q.gap_summary(df).first()
    assert (gs["total_points"], gs["gaps_count"], gs["max_gap_hours"]) == (4, 1, 4.0)
    mo = Q.missing_overall(df).first()
    assert mo["missing_cells"] == 1 and mo["missing_pct"] == 5.0
    assert mo["passed"] is True                   # the limit is "more than 5 %"


def test_structure_and_summary(spark):
    df = _df(spark)
    assert Q.structure_check(df.drop("capacity_mw")).first()["missing_columns"] == "capacity_mw"
    assert Q.structure_check(df).first()["passed"] is True
    checks = Q.check_table(df)
    s = Q.validation_summary(checks).first()
    assert s["overall_passed"] is True           # a negative value is an issue but does not fail
    assert s["total_issues"] == 1                 # negative generation
    assert s["total_warnings"] >= 2               # over-generation, duplicates, gaps, ...
    head = Q.issue_head(checks, 5, "issue").collect()
    assert [r["rank"] for r in head] == list(range(1, len(head) + 1))
    empty = Q.validation_summary(Q.check_table(df.filter(F.lit(False)))).first()
    assert empty["overall_passed"] is False


def test_gap_summary_across_buckets(spark):
    df = _df(spark)
    for hours in (1, 2, 720):
        gs = Q.gap_summary(df, bucket_hours=hours).first()
        assert (gs["total_points"], gs["gaps_count"], gs["max_gap_hours"]) == (4, 1, 4.0)


def _windy(spark, values):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(hours=i // 2 * 5), f"w{i % 3}", "wind", g, 10.0, w) for i, (g, w) in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA + ", wind_speed double").repartition(3)


@pytest.mark.parametrize("name,values", [
    ("constant", [(0.1, float(i)) for i in range(40)]),
    ("constant wind", [(float(i), 0.3) for i in range(40)]),
    ("offset", [(1e6 + 1e-6 * (i * 37 % 11), float(i * 37 % 11)) for i in range(60)]),
    ("far", [(1e9 + (i * 7 % 13), -1e9 - (i * 7 % 13) ** 2) for i in range(60)]),
    ("spread", [((i * 31 % 17) / 7, (i * 13 % 19) / 3) for i in range(80)]),
    ("nulls", [(None if i % 3 else float(i), float(i * i % 7)) for i in range(50)]),
    ("none", [(None, 1.0)] * 5)])
@pytest.mark.parametrize("bucket", [1, 24, 720])
def test_reported_correlation_equals_the_check(spark, name, values, bucket, monkeypatch):
    df = _windy(spark, values)
    cells = Q.check_cells
    monkeypatch.setattr(Q, "check_cells", lambda *a: cells(*a, bucket_hours=bucket))
    got = Q.check_table(df).where("item = 'wind_speed_correlation'").first()
    want = Q.corr_check(df, "wind").first()
    assert (got["value"] is None) == (want["correlation"] is None)
    if want["correlation"] is not None:
        assert abs(got["value"] - want["correlation"]) < 1e-6 and got["flagged"] == want["weak"]


@pytest.mark.parametrize("bucket", [1, 5, 720])
def test_report_counts_times_and_gaps(spark, bucket, monkeypatch):
    t0 = dt.datetime(2024, 1, 1)
    times = [t0 + dt.timedelta(hours=h) for h in (0, 1, 1, 1, 2, 9, 9, 40)] + [None, None, None]
    rows = [(t, p, "wind", 1.0, 10.0) for p in ("a", "b") for t in times] + [(None, "c", "wind", 1.0, 10.0), (t0, None, "wind", 1.0, 10.0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    cells = Q.check_cells
    monkeypatch.setattr(Q, "check_cells", lambda *a: cells(*a, bucket_hours=bucket))
    got = {r["item"]: r["value"] for r in Q.check_table(df).collect()}
    assert got["duplicate_keys"] == Q.duplicate_keys(df).first()[0] == 2 * (2 + 1 + 2)
    assert got["gaps:a"] == got["gaps:b"] == 2 and got["gaps:c"] == 0


def test_messages_name_the_side(spark):
    checks = spark.createDataFrame([("physical", "wind_speed_correlation", True, "warning"), ("physical", "over_generation", True, "warning")],
                                   "check string, item string, flagged boolean, severity string")
    assert {r["message"] for r in Q.check_messages(checks).collect()} == {
        "physical: wind_speed_correlation below its limit", "physical: over_generation above its limit"}

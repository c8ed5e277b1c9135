"""Property test: limited interpolation equals pandas on random series,
whatever the bucket length (so values are carried across many buckets)."""

import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import hourly
from wattline.operators.repair import interpolate

series = st.lists(st.one_of(st.none(), st.floats(min_value=-100, max_value=100, allow_nan=False)), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None)
@given(values=series, limit=st.integers(min_value=1, max_value=6), bucket=st.sampled_from([1, 2, 5, 720]))
def test_linear_interpolation_matches_pandas(spark, values, limit, bucket):
    expect = pd.Series(values, dtype=float).interpolate(method="linear", limit=limit).tolist()
    rows = [("p", t, v) for t, v in zip(hourly(n=len(values)), values)]
    df = spark.createDataFrame(rows, "plant_name string, timestamp timestamp_ntz, x double")
    got = [r["x"] for r in interpolate(df, ["x"], limit=limit, method="linear", bucket_hours=bucket)
           .orderBy("timestamp").collect()]
    for g, e in zip(got, expect):
        if math.isnan(e):
            assert g is None
        else:
            assert g is not None and abs(g - e) <= 1e-9 * max(1.0, abs(e))

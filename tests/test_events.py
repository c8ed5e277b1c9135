"""CUSUM and runs over time buckets against sequential loops."""

import datetime as dt
import random

import pytest

from wattline.operators import events as EV

T0 = dt.datetime(2024, 1, 1)


def series(seed, n=300):
    rnd = random.Random(seed)
    rows = []
    for p in ("a", "b"):
        t = T0
        for _ in range(n if p == "a" else 7):
            t += dt.timedelta(hours=rnd.choice([1, 1, 1, 1, 2, 30]))
            rows.append((p, t, None if rnd.random() < 0.05 else round(rnd.gauss(0, 1), 3)))
    return rows


def frame(spark, rows):
    extra = [("a", None, 5.0), (None, T0, 5.0)]
    return spark.createDataFrame(rows + extra, "plant_name string, timestamp timestamp_ntz, v double").repartition(5)


@pytest.mark.parametrize("bucket", [24, 97, 720])
def test_cusum(spark, bucket):
    rows = series(1)
    got = {(r["plant_name"], r["timestamp"]): r for r in EV.cusum(frame(spark, rows), "v", slack=0.2, limit=3.0, bucket_hours=bucket).collect()}
    assert len(got) == len(rows)
    for p in ("a", "b"):
        up = down = 0.0
        for _, t, v in sorted((r for r in rows if r[0] == p), key=lambda r: r[1]):
            if v is not None:
                up, down = max(0.0, up + v - 0.2), max(0.0, down - v - 0.2)
            r = got[p, t]
            assert abs(r["up"] - up) < 1e-9 and abs(r["down"] - down) < 1e-9
            assert r["alarm"] == ("up" if up > 3.0 else "down" if down > 3.0 else None)


@pytest.mark.parametrize("bucket,gap", [(24, 1.0), (50, 2.0), (720, 40.0)])
def test_ramps(spark, bucket, gap):
    rows = [r for r in series(2, 500) if r[2] is not None]
    got = sorted((r["plant_name"], r["direction"], r["start"], r["end"], r["rows"], round(r["size"], 9))
                 for r in EV.ramp_events(frame(spark, rows), "v", 0.6, max_gap_hours=gap, bucket_hours=bucket).collect())
    want = []
    for p in ("a", "b"):
        own = sorted((r for r in rows if r[0] == p), key=lambda r: r[1])
        run = None
        for before, now in zip([None, *own], own):
            near = before is not None and now[1] - before[1] <= dt.timedelta(hours=gap)
            step = now[2] - before[2] if near else None
            label = None if step is None else "up" if step >= 0.6 else "down" if step <= -0.6 else None
            if run and run[1] == label and near:
                run[3], run[4], run[5] = now[1], run[4] + 1, run[5] + step
                continue
            if run:
                want.append(run)
            run = [p, label, now[1], now[1], 1, step] if label else None
        if run:
            want.append(run)
    assert want and got == sorted((*w[:5], round(w[5], 9)) for w in want)


def test_runs_of_empty_input(spark):
    df = frame(spark, []).where("plant_name = 'zz'")
    assert EV.cusum(df, "v").count() == 0 and EV.ramp_events(df, "v", 1.0).count() == 0

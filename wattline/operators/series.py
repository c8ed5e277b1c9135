"""Per-series row operators on irregular series (bucketed by time, skew-safe)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline import config as C
from wattline.operators.windows import NULL_BUCKET, NULL_BUCKETS, epoch_micros


def time_diff(df: DataFrame, keys: Sequence[str] = ("plant_name",), ts: str = "timestamp",
              tiebreak: Sequence[str] = (), out: str = "dt_seconds",
              bucket_hours: int = C.Defaults().carry_bucket_hours) -> DataFrame:
    """Seconds elapsed since the previous row of the same key (NULL first).

    ``lag`` inside each (key, time bucket); the first row of a bucket takes
    the last time of the key's previous bucket from a one-row-per-bucket
    summary.  Rows without a time get NULL and pass by the windows."""
    timed = df.filter(F.col(ts).isNotNull()).withColumn("_tb", F.floor(epoch_micros(ts) / F.lit(3_600_000_000 * bucket_hours)))
    ends = timed.groupBy(*keys, "_tb").agg(F.max(ts).alias("_end"))
    ends = ends.select(*keys, "_tb", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_tb")).alias("_before"))
    w = Window.partitionBy(*keys, "_tb").orderBy(ts, *tiebreak)
    j = timed.withColumn("_lag", F.lag(ts).over(w)).join(ends, on=[*keys, "_tb"], how="left")
    dt = (epoch_micros(ts) - epoch_micros(F.coalesce("_lag", "_before"))).cast("double") / F.lit(1e6)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    timed = j.withColumn(out, F.when(known, dt)).select(*df.columns, out)
    rest = df.filter(F.col(ts).isNull()).withColumn(out, F.lit(None).cast("double"))
    return timed.unionByName(rest)


def row_index(df: DataFrame, keys: Sequence[str] = ("plant_name",), ts: str = "timestamp",
              tiebreak: Sequence[str] = (), out: str = "rn",
              bucket_hours: int = C.Defaults().carry_bucket_hours) -> DataFrame:
    """1-based position of each row within its key in time order.

    ``row_number`` per (key, time bucket) plus the row count of the key's
    earlier buckets (a partial aggregate and one small window over buckets,
    joined back on the window's own partitioning): no task holds a whole key
    and nothing is checkpointed.  Rows with a null key get NULL; rows without
    a time come first, in an arbitrary but fixed order."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    b = F.coalesce(F.floor(us / F.lit(3_600_000_000 * bucket_hours)).cast("long"), F.lit(NULL_BUCKET) + F.pmod(F.xxhash64(*df.columns), F.lit(NULL_BUCKETS)))
    d = df.withColumn("_rb", b)
    w = Window.partitionBy(*keys, "_rb").orderBy(ts, *tiebreak)
    local = d.withColumn("_lp", F.row_number().over(w).cast("long"))
    counts = d.groupBy(*keys, "_rb").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_rb", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long").alias("_off"))
    j = local.join(offsets, on=[*keys, "_rb"], how="left")
    return j.withColumn(out, F.col("_off") + F.col("_lp")).drop("_rb", "_lp", "_off")


def split_chronological(df: DataFrame, keys: Sequence[str] = ("plant_name",), rn: str = "rn",
                        train: float = 0.7, val: float = 0.2) -> DataFrame:
    """``split`` = train / val / test by position: first floor(n*train) rows,
    next floor(n*val), rest (per key)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    j = df.join(counts, on=list(keys), how="left")
    n_tr = F.floor(F.col("_n") * F.lit(train))
    n_va = F.floor(F.col("_n") * F.lit(val))
    split = F.when(F.col(rn) <= n_tr, "train").when(F.col(rn) <= n_tr + n_va, "val").otherwise("test")
    start = F.when(F.col(rn) <= n_tr, F.lit(0)).when(F.col(rn) <= n_tr + n_va, n_tr).otherwise(n_tr + n_va)
    return j.withColumn("split", split).withColumn("rn_split", (F.col(rn) - start).cast("long")).drop("_n")


def split_timeseries_cv(df: DataFrame, keys: Sequence[str] = ("plant_name",), rn: str = "rn",
                        n_splits: int = 3) -> DataFrame:
    """Last fold of an expanding k-fold time split: validation = last
    floor(n/(k+1)) rows, train = everything before."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    j = df.join(counts, on=list(keys), how="left")
    size = F.floor(F.col("_n") / F.lit(n_splits + 1))
    return j.withColumn("fold", F.when(F.col(rn) > F.col("_n") - size, "val").otherwise("train")).drop("_n")


def split_random(df: DataFrame, key: str, seed: int = 42, train_pct: int = 80) -> DataFrame:
    """Reproducible random split from an arithmetic hash of an integer key
    (stable under any repartitioning, unlike ``randomSplit``)."""
    h = F.pmod(F.pmod(F.col(key), F.lit(1000003)) * F.lit(2654435761) + F.lit(seed), F.lit(1000003))
    return df.withColumn("split", F.when(F.pmod(h, F.lit(100)) < train_pct, "train").otherwise("test"))


def multi_horizon_frame(df: DataFrame, value: str, horizon: int = 24, keys: Sequence[str] = ("plant_name",),
                        ts: str = "timestamp") -> DataFrame:
    """One row per origin x step 1..H with the value observed ``step`` hours
    after the origin (direct multi-horizon target).  A generator plus an
    equi-join on (key, time): balanced whatever the key skew."""
    origins = df.select(*keys, F.col(ts).alias("origin"), F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    origins = origins.withColumn(ts, F.timestamp_add("HOUR", F.col("step"), F.col("origin")))
    target = df.select(*keys, ts, F.col(value).alias("target"))
    return origins.join(target, on=[*keys, ts], how="left").select(*keys, "origin", "step", F.col(ts).alias("target_time"), "target")

"""Joins: nearest-in-time (as-of), exact time, site-keyed, spine, group map,
keyed prediction alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators.windows import carry_valid, epoch_micros


CARRY_GROUP = 720  # index buckets whose carries one window computes


def _pick(prev, nxt, on: str, direction: str):
    if direction == "backward":
        return prev["v"]
    if direction == "forward":
        return nxt["v"]
    if direction != "nearest":
        raise ValueError(direction)
    d_prev = epoch_micros(on) - epoch_micros(prev["t"])
    d_next = epoch_micros(nxt["t"]) - epoch_micros(on)
    return F.when(nxt.isNull(), prev["v"]).when(prev.isNull(), nxt["v"]).when(
        d_prev <= d_next, prev["v"]).otherwise(nxt["v"])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str = "timestamp",
    by: Sequence[str] = (),
    right_cols: Sequence[str] | None = None,
    direction: str = "nearest",
    bucket_seconds: int = 3600,
) -> DataFrame:
    """Attach to each left row the right row nearest in time (per ``by``).

    ``direction``: ``backward`` (last right row at or before), ``forward``
    (first at or after) or ``nearest`` (smaller gap; equal gap -> earlier).
    No tolerance: the nearest row is taken however far away.

    Rows without a time, or whose ``by`` is unknown on the right, get NULLs.

    Plan (left side is large, right side is a time series): an index with
    one row per (by, time bucket) that holds right rows or is asked for by
    left rows -- the bucket's right rows as a sorted array plus the last row
    before and the first row after it.  Left rows are equi-joined to their
    bucket, which AQE broadcasts once it has measured the index, so left
    rows are neither sorted nor windowed.  The carries come from windows
    over coarse groups of buckets and one row per group, so a long series
    is many tasks, and a stray time of another century costs one row.
    Pick ``bucket_seconds`` so a bucket holds few right rows (hourly
    weather: one).  :func:`asof_join_carry` is the alternative when the
    right side is as large as the left.
    """
    if right_cols is None:
        right_cols = [c for c in right.columns if c != on and c not in by]
    lcols = left.columns
    clash = [c for c in right_cols if c in lcols]
    if clash:
        raise ValueError(f"right columns already on the left: {clash}")
    by = list(by)
    us = F.lit(bucket_seconds * 1_000_000)
    bucket = lambda c: F.floor(epoch_micros(c) / us).cast("long")
    r = right.filter(F.col(on).isNotNull()).select(
        *by, bucket(on).alias("_b"), F.struct(F.col(on).alias("t"), F.struct(*right_cols).alias("v")).alias("_r"))
    cells = r.groupBy(*by, "_b").agg(F.sort_array(F.collect_list("_r")).alias("_rows"))
    asked = left.filter(F.col(on).isNotNull()).select(*by, bucket(on).alias("_b")).distinct()
    empty = F.array().cast(cells.schema["_rows"].dataType)
    idx = asked.join(cells, on=[*by, "_b"], how="full").withColumn("_rows", F.coalesce("_rows", empty)) \
        .withColumn("_g", F.floor(F.col("_b") / F.lit(CARRY_GROUP)))
    first, last = F.try_element_at("_rows", F.lit(1)), F.try_element_at("_rows", F.lit(-1))
    inner, outer = Window.partitionBy(*by, "_g"), Window.partitionBy(*(by or [F.lit(0)]))
    earlier, later = (Window.unboundedPreceding, -1), (1, Window.unboundedFollowing)
    groups = idx.groupBy(*by, "_g").agg(F.min(F.when(first.isNotNull(), F.struct("_b", first.alias("r"))))["r"].alias("_first"),
                                        F.max(F.when(last.isNotNull(), F.struct("_b", last.alias("r"))))["r"].alias("_last"))
    groups = groups.select(*by, "_g", F.last("_last", True).over(outer.orderBy("_g").rowsBetween(*earlier)).alias("_gin"),
                           F.first("_first", True).over(outer.orderBy("_g").rowsBetween(*later)).alias("_gout"))
    idx = idx.select(*by, "_b", "_g", "_rows", F.last(last, True).over(inner.orderBy("_b").rowsBetween(*earlier)).alias("_cin"),
                     F.first(first, True).over(inner.orderBy("_b").rowsBetween(*later)).alias("_cout")) \
        .join(groups, on=[*by, "_g"], how="left") \
        .select(*by, "_b", "_rows", F.coalesce("_cin", "_gin").alias("_cin"), F.coalesce("_cout", "_gout").alias("_cout"))
    # rows without a time match nothing; a spread key keeps them from meeting in one task
    nowhere = F.lit(-(1 << 62)) + F.pmod(F.xxhash64(*lcols), F.lit(4096))
    lb = left.withColumn("_b", F.coalesce(bucket(on), nowhere))
    j = lb.join(idx, on=[*by, "_b"], how="left")
    t = F.col(on)
    before = F.filter("_rows", lambda x: x["t"] <= t)
    after = F.filter("_rows", lambda x: x["t"] >= t)
    prev = F.coalesce(F.try_element_at(before, F.lit(-1)), F.col("_cin"))
    nxt = F.coalesce(F.try_element_at(after, F.lit(1)), F.col("_cout"))
    j = j.withColumns({"_prev": prev, "_next": nxt})
    pick = _pick(F.col("_prev"), F.col("_next"), on, direction)
    return j.select(*[F.col(c) for c in lcols], *[F.when(t.isNotNull(), pick[c]).alias(c) for c in right_cols])


def asof_join_carry(
    left: DataFrame,
    right: DataFrame,
    on: str = "timestamp",
    by: Sequence[str] = (),
    right_cols: Sequence[str] | None = None,
    direction: str = "nearest",
    bucket_hours: int = 24,
) -> DataFrame:
    """Same result as :func:`asof_join` for a right side as large as the
    left: both sides are unioned and scanned per ``(by, time bucket)``; the
    last / first right row is carried across buckets by :func:`carry_valid`.
    """
    if right_cols is None:
        right_cols = [c for c in right.columns if c != on and c not in by]
    lcols = left.columns
    r = right.select(*by, on, F.struct(*right_cols).alias("_w"), F.lit(0).alias("_side"))
    l_ = left.withColumn("_side", F.lit(1))
    u = l_.unionByName(r, allowMissingColumns=True)
    carried = carry_valid(u, list(by), on, {"w": "_w"}, tiebreak=["_side"], bucket_hours=bucket_hours)
    carried = carried.filter(F.col("_side") == 1)
    # right rows sort before left rows of the same time: an equal one is the previous row and, forwards, the next one too
    following = F.when(F.col("_prev_w")["t"] == F.col(on), F.col("_prev_w")).otherwise(F.col("_next_w"))
    pick = _pick(F.col("_prev_w"), following, on, direction)
    return carried.select(*[F.col(c) for c in lcols], *[F.when(F.col(on).isNotNull(), pick[c]).alias(c) for c in right_cols])


def aggregate_weather_by_time(weather: DataFrame, cols: Sequence[str], ts: str = "timestamp") -> DataFrame:
    """Mean of each weather column per timestamp across sites."""
    present = [c for c in cols if c in weather.columns]
    return weather.groupBy(ts).agg(*[F.avg(c).alias(c) for c in present])


def merge_weather(generation: DataFrame, weather: DataFrame, cols: Sequence[str], ts: str = "timestamp",
                  plant_filter: Sequence[str] | None = None, bucket_seconds: int = 3600) -> DataFrame:
    """Filter plants, average weather per time, nearest as-of join."""
    if plant_filter:
        generation = generation.filter(F.col("plant_name").isin(list(plant_filter)))
    wagg = aggregate_weather_by_time(weather, cols, ts)
    return asof_join(generation, wagg, on=ts, direction="nearest", bucket_seconds=bucket_seconds)


def join_equi_time(generation: DataFrame, weather: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Inner join on the exact timestamp (fans out on several weather rows)."""
    return generation.join(weather, on=ts, how="inner")


def join_site_weather(weather: DataFrame, plants: DataFrame, site: str = "location") -> DataFrame:
    """Give every plant the weather series of its site (equi join on site).

    With a single site this is the "every plant sees the whole weather
    series" rule; the plant table is a dimension, and AQE broadcasts it
    only after measuring it.
    """
    return weather.join(plants, on=site, how="inner")


def hourly_spine(df: DataFrame, keys: Sequence[str] = ("plant_name",), ts: str = "timestamp",
                 step: str = "INTERVAL 1 HOUR") -> DataFrame:
    """Every hour between each key's first and last hour."""
    hour = F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")
    bounds = df.groupBy(*keys).agg(F.min(hour).alias("_lo"), F.max(hour).alias("_hi"))
    return bounds.select(*keys, F.explode(F.sequence("_lo", "_hi", F.expr(step))).alias(ts))


def join_spine(df: DataFrame, keys: Sequence[str] = ("plant_name",), ts: str = "timestamp") -> DataFrame:
    """Left-join observations (already on whole hours) to the hourly spine."""
    spine = hourly_spine(df, keys, ts)
    return spine.join(df, on=[*keys, ts], how="left")


def attach_group_mean(df: DataFrame, value: str, group: Sequence[str], out: str,
                      fit: DataFrame | None = None) -> DataFrame:
    """Group mean of ``value`` attached to each row.

    The means are aggregated (partial aggregation map-side, one small row
    per group) on ``fit`` -- the frame itself when None (in-sample) -- and
    joined back by key; a left join keeps groups unseen in ``fit``.  Unlike
    a window over the group, no row is shuffled by a possibly hot key.
    """
    means = (df if fit is None else fit).groupBy(*group).agg(F.avg(value).alias(out))
    return df.join(means, on=list(group), how="left")


def join_predictions(preds: DataFrame, models: Sequence[str], keys: Sequence[str] = ("plant_name", "timestamp"),
                     model_col: str = "model", value_col: str = "P50", keep: Sequence[str] = ("y_true",)) -> DataFrame:
    """Long predictions -> one row per key, one column per model (by key,
    never by position), plus the per-key columns in ``keep``.

    Conditional aggregation over an explicit model list: one partial
    aggregation, no extra job to discover pivot values."""
    aggs = [F.max(c).alias(c) for c in keep]
    aggs += [F.max(F.when(F.col(model_col) == m, F.col(value_col))).alias(m) for m in models]
    return preds.groupBy(*keys).agg(*aggs)

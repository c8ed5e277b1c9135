"""Plant and fleet summaries (capacity factor views, cards, heads, samples)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.forecast import round_half_even
from wattline.functions.physics import capacity_factor


def first_row_per_plant(df: DataFrame, cols: Sequence[str], key: str = "plant_name", ts: str = "timestamp",
                        tiebreak: Sequence[str] = ()) -> DataFrame:
    """Attributes from each plant's earliest row (partial aggregation, no window)."""
    packed = F.min(F.struct(F.col(ts), *[F.col(t) for t in tiebreak], *[F.col(c) for c in cols])).alias("_f")
    return df.groupBy(key).agg(packed).select(key, *[F.col(f"_f.{c}").alias(c) for c in cols])


def total_capacity(df: DataFrame, key: str = "plant_name", cap: str = "capacity_mw", ts: str = "timestamp",
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """Sum over plants of each plant's first capacity (two-level aggregation)."""
    first = first_row_per_plant(df, [cap], key, ts, tiebreak)
    return first.agg(F.sum(cap).alias("total_capacity_mw"), F.count(F.lit(1)).alias("plants"))


def cf_by_type(df: DataFrame, type_col: str = "plant_type") -> DataFrame:
    return df.groupBy(type_col).agg(F.avg(capacity_factor()).alias("mean_capacity_factor"))


def cf_monthly_pivot(df: DataFrame, ts: str = "timestamp", type_col: str = "plant_type", digits: int = 3) -> DataFrame:
    """plant type x month (1..12) mean capacity factor, rounded half-even."""
    g = df.withColumn("_m", F.month(ts)).groupBy(type_col).pivot("_m", list(range(1, 13))) \
        .agg(round_half_even(F.avg(capacity_factor()), digits))
    return g.select(type_col, *[F.col(str(m)).alias(f"m{m:02d}") for m in range(1, 13)])


def cf_hourly(df: DataFrame, key: str = "plant_name", ts: str = "timestamp") -> DataFrame:
    """Per plant and hour of day: mean generation / plant capacity."""
    g = df.groupBy(key, F.hour(ts).cast("int").alias("hour")).agg(
        F.avg("generation_mw").alias("mean_generation_mw"), F.max("capacity_mw").alias("_cap"))
    return g.select(key, "hour", "mean_generation_mw",
                    F.try_divide(F.col("mean_generation_mw"), F.col("_cap")).alias("capacity_factor"))


def plant_summary(df: DataFrame, key: str = "plant_name", ts: str = "timestamp") -> DataFrame:
    """Card values: average, peak, capacity factor %, points, date range."""
    g = df.groupBy(key).agg(
        F.avg("generation_mw").alias("avg_generation_mw"),
        F.max("generation_mw").alias("peak_generation_mw"),
        F.max("capacity_mw").alias("capacity_mw"),
        F.count(F.lit(1)).alias("data_points"),
        F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    return g.select(key, "avg_generation_mw", "peak_generation_mw",
                    (F.try_divide(F.col("avg_generation_mw"), F.col("capacity_mw")) * 100.0).alias("capacity_factor_pct"),
                    "data_points",
                    F.date_format("_lo", "yyyy-MM-dd").alias("start_date"),
                    F.date_format("_hi", "yyyy-MM-dd").alias("end_date"))


def head_forecast(preds: DataFrame, n: int, ts: str = "timestamp", keys: Sequence[str] = ("plant_name",),
                  digits: int = 2) -> DataFrame:
    """First ``n`` rows in time order with rounded actual / predicted / error."""
    top = preds.orderBy(F.col(ts), *[F.col(k) for k in keys]).limit(n)
    return top.select(ts, *keys, round_half_even("y_true", digits).alias("actual"),
                      round_half_even("P50", digits).alias("predicted"),
                      round_half_even(F.abs(F.col("y_true") - F.col("P50")), digits).alias("error"))


def sample_sorted(df: DataFrame, n: int, key: str, seed: int = 42, ts: str = "timestamp") -> DataFrame:
    """Deterministic sample of ``n`` rows (smallest arithmetic hash of an
    integer key, ties by the key), in time order.

    A distributed top-k (TakeOrderedAndProject); reproducible under any
    partitioning, unlike ``sample``."""
    h = F.pmod(F.pmod(F.col(key), F.lit(1000003)) * F.lit(2654435761) + F.lit(seed), F.lit(1000003))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).orderBy(ts, key).drop("_h")

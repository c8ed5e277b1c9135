"""Calendar and cyclical features (pure column expressions)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def calendar_columns(ts: str | Column = "timestamp") -> dict[str, Column]:
    t = _c(ts)
    wd = F.weekday(t)  # Monday = 0
    return {
        "hour": F.hour(t).cast("int"),
        "day_of_year": F.dayofyear(t).cast("int"),
        "month": F.month(t).cast("int"),
        "weekday": wd.cast("int"),
        "is_weekend": F.when(wd.isin(5, 6), F.lit(1)).otherwise(F.lit(0)).cast("int"),
    }


def cyclical(x: str | Column, period: float) -> tuple[Column, Column]:
    arg = F.lit(2.0 * math.pi) * _c(x).cast("double") / F.lit(float(period))
    return F.sin(arg), F.cos(arg)


def cyclical_columns(hour="hour", month="month", day_of_year="day_of_year") -> dict[str, Column]:
    out = {}
    for name, col, period in (("hour", hour, 24.0), ("month", month, 12.0), ("dayofyear", day_of_year, 365.25)):
        if col is None:
            continue
        s, c = cyclical(col, period)
        out[f"{name}_sin"] = s
        out[f"{name}_cos"] = c
    return out


def add_calendar_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """hour, day_of_year, month, weekday (Mon=0), is_weekend + 6 sin/cos."""
    df = df.withColumns(calendar_columns(ts))
    return df.withColumns(cyclical_columns())

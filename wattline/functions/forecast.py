"""Forecast-output expressions: intervals, confidence, labels, rounding, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattline import config as C


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def interval_fallback(p50="P50", p10="P10", p90="P90", factors=C.INTERVAL_FALLBACK) -> tuple[Column, Column]:
    """(P10, P90) with ``P50 * lo`` / ``P50 * hi`` where a quantile is missing."""
    lo, hi = factors
    return (F.coalesce(_c(p10), _c(p50) * F.lit(lo)), F.coalesce(_c(p90), _c(p50) * F.lit(hi)))


def uncertainty_range(p10="P10", p90="P90") -> Column:
    return F.coalesce(_c(p90), F.lit(0.0)) - F.coalesce(_c(p10), F.lit(0.0))


def confidence_level(rng: str | Column, capacity: str | Column | float = C.DEFAULT_CAPACITY) -> Column:
    cap = capacity if isinstance(capacity, Column) else (F.col(capacity) if isinstance(capacity, str) else F.lit(float(capacity)))
    ratio = F.try_divide(_c(rng), cap)
    return (
        F.when(ratio < C.CONFIDENCE_HIGH, F.lit("High"))
        .when(ratio < C.CONFIDENCE_MEDIUM, F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )


def round_half_even(x, digits: int = 2) -> Column:
    """Half-even ("banker's") rounding of the decimal value.

    The double is first rounded to 9 decimals so binary noise (127.36499...
    vs 127.36500...01) cannot decide a tie; then ``bround``."""
    return F.bround(F.round(_c(x), 9), digits)


def quantile_label(q) -> Column:
    return F.concat(F.lit("P"), F.round(_c(q) * 100).cast("int").cast("string"))


def name_slug(x) -> Column:
    return F.regexp_replace(F.lower(_c(x)), " ", "_")


def display_name(x) -> Column:
    return F.initcap(F.regexp_replace(_c(x), "_", " "))

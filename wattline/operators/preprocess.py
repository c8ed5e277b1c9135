"""Model-input preprocessing fitted as small aggregate tables.

Fitted state is a tiny DataFrame (one row per feature or per category) and
is applied through scalar subqueries or a key join -- never collected to
the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators.ranks import ranked


def scaler_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, mean, std) with population std; zero / undefined std -> 1."""
    row = df.agg(*[F.avg(c).alias(f"m__{c}") for c in cols], *[F.stddev_pop(c).alias(f"s__{c}") for c in cols])
    stack = ", ".join(f"'{c}', `m__{c}`, `s__{c}`" for c in cols)
    long = row.selectExpr(f"stack({len(cols)}, {stack}) as (feature, mean, std)")
    return long.withColumn("std", F.when(F.col("std").isNull() | (F.col("std") == 0), F.lit(1.0)).otherwise(F.col("std")))


def scaler_transform(df: DataFrame, stats: DataFrame, cols: Sequence[str], inverse: bool = False) -> DataFrame:
    fitted = stats.agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct("mean", "std")))).alias("m")).select("m").scalar()
    out = {}
    for c in cols:
        mean, std = fitted[c]["mean"], fitted[c]["std"]
        out[c] = F.col(c) * std + mean if inverse else (F.col(c) - mean) / std
    return df.withColumns(out)


def label_encoder_fit(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values -> 0..k-1, numbered by ranges of values: no task
    sees all of them."""
    d = df.select(F.col(col).alias("value")).filter(F.col("value").isNotNull()).distinct()
    return ranked(d, ["value"], out="label").withColumn("label", F.col("label").cast("int"))


def label_encode(df: DataFrame, encoder: DataFrame, col: str, out: str | None = None, unseen: int = -1) -> DataFrame:
    out = out or f"{col}_encoded"
    enc = encoder.select(F.col("value").alias(col), F.col("label").alias(out))
    return df.join(enc, on=col, how="left").withColumn(out, F.coalesce(F.col(out), F.lit(unseen)))


def mean_impute(df: DataFrame, cols: Sequence[str], fit: DataFrame | None = None) -> DataFrame:
    """Nulls -> column mean of ``fit`` (default: the frame itself)."""
    src = df if fit is None else fit
    means = src.agg(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("m")).select("m").scalar()  # one row, one scan
    return df.withColumns({c: F.coalesce(F.col(c), means[c]) for c in cols})

"""Late readings into a written feature table.

A plant's features depend on its own readings and the weather alone, so the
plants of late readings are computed again and the others are left.  Of those
plants only the months whose rows differ from the stored ones are written,
folder by folder (dynamic partition overwrite); the gap fills and the lags
that a late reading reaches decide which these are.  All other files stay as
they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.plans.pipeline import pipeline_features
from wattline.session import materialize
from wattline.sources.sinks import MONTH, write_features

DIGITS = 9  # stored and recomputed numbers count as equal if they agree so far


def _prints(rows: DataFrame, parts: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row for each folder: how many rows it has and the sum of their hashes."""
    kinds = dict(rows.dtypes)
    shown = [F.round(c, DIGITS) if kinds[c] in ("double", "float") else F.col(c) for c in cols]
    return rows.groupBy(*parts).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*shown).cast("decimal(38,0)")).alias("hashes"))


def refresh_features(path: str, generation: DataFrame, weather: DataFrame, late: DataFrame, keys: Sequence[str] = ("plant_name",),
                     ts: str = "timestamp", tiebreak: Sequence[str] = (), **pipeline) -> DataFrame:
    """Bring the table at ``path`` (written by :func:`sinks.write_features`)
    up to date and return the folders written, as (keys, year_month).

    ``generation``: all readings, the late ones included; ``late``: the late
    ones.  Late weather reaches every plant: give all readings as ``late``
    then.  Afterwards the table equals one built anew.  The new months of the
    touched plants are written to the shared folder first, so the table may be
    read while they are computed."""
    spark = generation.sparkSession
    parts = [*keys, MONTH]
    touched = late.select(*keys).distinct()
    fresh = pipeline_features(generation.join(touched, list(keys), "left_semi"), weather, keys=keys, ts=ts, tiebreak=tiebreak, **pipeline)
    cols = fresh.columns
    fresh = materialize(fresh.withColumn(MONTH, F.date_format(ts, "yyyy-MM")))
    stored = spark.read.parquet(path).drop(MONTH)
    stored = stored.withColumns({k: F.col(k).cast(fresh.schema[k].dataType) for k in keys}).select(*cols)
    stored = stored.join(touched, list(keys), "left_semi").withColumn(MONTH, F.date_format(ts, "yyyy-MM"))
    new, old = _prints(fresh, parts, cols), _prints(stored, parts, cols).withColumnsRenamed({"rows": "_rows", "hashes": "_hashes"})
    differs = F.col("_rows").isNull() | (F.col("rows") != F.col("_rows")) | (F.col("hashes") != F.col("_hashes"))
    changed = materialize(new.join(old, parts, "left").filter(differs).select(*parts))
    write_features(fresh.join(changed, parts, "left_semi").select(*cols), path, keys, ts, dynamic=True)
    return changed

"""Ranks over whole columns without a one-task window.

Rows are range-partitioned by the sort columns and sorted inside partitions;
a row's position is its place in its partition plus the sizes of the
partitions before it.  The sorted rows are written once, because the range
borders come from a sample and both readers must see the same ones.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.session import materialize

_SLOT = 33  # bits of a row's place inside its partition


def ranked(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """``df`` with ``out``: the 0-based position of each row among the rows of
    its key, by ``order``.  Rows equal in ``keys`` and ``order`` get different
    positions.  ``order`` should tell rows apart: equal rows stay in one
    partition."""
    if out in df.columns:
        raise ValueError(f"column {out!r} is there already")
    cols = [*keys, *order]
    placed = materialize(df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _SLOT)
    sizes = placed.groupBy(*keys, part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    if keys:
        before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    else:  # one row for each partition of the shuffle
        counts = sorted((r["_part"], r["_n"], r["_first"]) for r in sizes.collect())
        ends = [0, *itertools.accumulate(n for _, n, _ in counts)]
        starts = df.sparkSession.createDataFrame([(*c, e) for c, e in zip(counts, ends)], "_part long, _n long, _first long, _before long")
    known = F.lit(True)
    starts = starts.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    for i, k in enumerate(keys):
        known = known & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    j = placed.withColumn("_p", part).join(starts, (F.col("_p") == F.col("_part")) & known)
    return j.withColumn(out, F.col("_before") + F.col("_at") - F.col("_first")).select(*df.columns, out)

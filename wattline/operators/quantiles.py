"""Exact order statistics per group without a buffer per group.

Rows are ranked by ranges of (group, value), so that a group may hold any
share of the rows and its values may be spread in any way: no task gets more
than one range.  The wanted ranks then meet the ranked rows by equality.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.operators.ranks import ranked


def values_at(df: DataFrame, keys: Sequence[str], value: str, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Per group: ``n`` (non-null values) and for each name the value of the
    0-based rank that ``ranks[name](n)`` gives in ascending order."""
    keys = list(keys)
    known = F.col(value).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    # equal values are dealt over ranges by a number of their own
    v = df.filter(known).select(*keys, F.col(value).cast("double").alias("_v"), F.monotonically_increasing_id().alias("_tie"))
    r = ranked(v, ["_v", "_tie"], keys, out="_rank")
    sizes = r.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    asked = F.array(*[F.struct(F.lit(name).alias("name"), rank(F.col("n")).cast("long").alias("rank")) for name, rank in ranks.items()])
    asked = sizes.select(*keys, "n", F.explode(asked).alias("_a")).select(*keys, "n", "_a.name", F.col("_a.rank").alias("_rank"))
    found = asked.join(r.select(*keys, "_rank", "_v"), [*keys, "_rank"])
    return found.groupBy(*keys).agg(F.max("n").alias("n"), *[F.max(F.when(F.col("name") == name, F.col("_v"))).alias(name) for name in ranks])


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Per group the linearly interpolated quantiles (as ``percentile`` gives)."""
    def low(q):
        return lambda n: F.floor(F.lit(float(q)) * (n - 1))

    def high(q):
        return lambda n: F.ceil(F.lit(float(q)) * (n - 1))

    ranks = {f"_l{i}": low(q) for i, q in enumerate(qs)} | {f"_h{i}": high(q) for i, q in enumerate(qs)}
    got = values_at(df, keys, value, ranks)
    out = []
    for i, (q, name) in enumerate(zip(qs, names, strict=True)):
        part = F.lit(float(q)) * (F.col("n") - 1) - F.floor(F.lit(float(q)) * (F.col("n") - 1))
        out.append((F.col(f"_l{i}") * (1 - part) + F.col(f"_h{i}") * part).alias(name))
    return got.select(*keys, *out)

"""Events along series: ramps (runs of steep hours) and error drift.

Both are scans along a whole series, split by time: each (key, time bucket)
is summed up, a window over one row for each bucket carries what earlier
buckets pass on, and the two meet again by equality on the bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators.windows import epoch_micros

BUCKET_HOURS = 720


def _bucket(ts: str, hours: int) -> Column:
    return F.floor(epoch_micros(ts) / F.lit(3_600_000_000 * hours)).cast("long")


def cusum(df: DataFrame, value: str, keys: Sequence[str] = ("plant_name",), ts: str = "timestamp", slack: float | str = 0.0,
          limit: float | str = 0.0, tiebreak: Sequence[str] = (), bucket_hours: int = BUCKET_HOURS) -> DataFrame:
    """Two-sided CUSUM of ``value`` along each key: ``up`` and ``down``, the
    running sums ``S = max(0, S + value - slack)`` and ``max(0, S - value -
    slack)``, and ``alarm`` (``up``, ``down`` or NULL) where one exceeds
    ``limit``.

    Such a sum is the prefix sum less its least value so far (0 included), so
    a bucket passes on its total and its least prefix.  ``slack`` and
    ``limit`` are numbers or names of columns that are constant for a key.
    Null values count as no step; rows without a time or a key take no part."""
    sl, li = (F.col(x) if isinstance(x, str) else F.lit(float(x)) for x in (slack, limit))
    known = F.col(ts).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    x = F.col(value).cast("double")
    d = df.filter(known).withColumns({"_eb": _bucket(ts, bucket_hours), "_su": F.when(x.isNotNull(), x - sl).otherwise(0.0),
                                      "_sd": F.when(x.isNotNull(), -x - sl).otherwise(0.0)})
    w = Window.partitionBy(*keys, "_eb").orderBy(ts, *tiebreak).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({"_pu": F.sum("_su").over(w), "_pd": F.sum("_sd").over(w)})
    d = d.withColumns({"_mu": F.min("_pu").over(w), "_md": F.min("_pd").over(w)})
    ends = d.groupBy(*keys, "_eb").agg(F.sum("_su").alias("_tu"), F.sum("_sd").alias("_td"), F.min("_pu").alias("_lu"), F.min("_pd").alias("_ld"))
    before = Window.partitionBy(*keys).orderBy("_eb").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumns({f"_o{c}": F.coalesce(F.sum(f"_t{c}").over(before), F.lit(0.0)) for c in "ud"})
    ends = ends.withColumns({f"_f{c}": F.least(F.lit(0.0), F.coalesce(F.min(F.col(f"_o{c}") + F.col(f"_l{c}")).over(before), F.lit(0.0))) for c in "ud"})
    j = d.join(ends.select(*keys, "_eb", "_ou", "_od", "_fu", "_fd"), [*keys, "_eb"])
    sums = {name: F.col(f"_o{c}") + F.col(f"_p{c}") - F.least(F.col(f"_f{c}"), F.col(f"_o{c}") + F.col(f"_m{c}")) for name, c in (("up", "u"), ("down", "d"))}
    j = j.withColumns(sums)
    alarm = F.when(F.col("up") > li, "up").when(F.col("down") > li, "down")
    return j.select(*df.columns, "up", "down", alarm.alias("alarm"))


def runs(df: DataFrame, label: str, keys: Sequence[str] = ("plant_name",), ts: str = "timestamp", tiebreak: Sequence[str] = (),
         step: str | None = None, max_gap_hours: float | None = None, bucket_hours: int = BUCKET_HOURS) -> DataFrame:
    """Maximal runs of consecutive rows of one ``label`` along each key:
    ``keys``, ``label``, ``start``, ``end``, ``rows`` and (with ``step``)
    ``size``, the sum of that column.  Rows with a null label end a run, and
    so does a step of more than ``max_gap_hours``.

    A row starts a run if the row before differs; in a bucket that is ``lag``,
    at its first row the last row of the key's bucket before.  Counting the
    starts numbers the runs across buckets."""
    known = F.col(ts).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    d = df.filter(known).withColumn("_eb", _bucket(ts, bucket_hours))
    w = Window.partitionBy(*keys, "_eb").orderBy(ts, *tiebreak)
    packed = F.struct(F.col(ts).alias("t"), F.col(label).alias("l"))
    d = d.withColumn("_last", F.lag(packed).over(w))
    tail = F.struct(F.col(ts), *[F.col(c) for c in tiebreak], packed.alias("_packed"))
    ends = d.groupBy(*keys, "_eb").agg(F.max(tail)["_packed"].alias("_tail"))
    ends = ends.select(*keys, "_eb", F.lag("_tail").over(Window.partitionBy(*keys).orderBy("_eb")).alias("_before"))
    j = d.join(ends, [*keys, "_eb"]).withColumn("_prev", F.coalesce("_last", "_before"))
    same = F.col("_prev").isNotNull() & F.col("_prev")["l"].eqNullSafe(F.col(label))
    if max_gap_hours is not None:
        same = same & (epoch_micros(ts) - epoch_micros(F.col("_prev")["t"]) <= F.lit(int(max_gap_hours * 3_600_000_000)))
    j = j.withColumn("_new", (~same).cast("long"))
    j = j.withColumn("_count", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    news = j.groupBy(*keys, "_eb").agg(F.sum("_new").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_eb").rowsBetween(Window.unboundedPreceding, -1)
    news = news.select(*keys, "_eb", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    numbered = j.join(news, [*keys, "_eb"]).withColumn("_run", F.col("_off") + F.col("_count")).filter(F.col(label).isNotNull())
    aggs = [F.min(ts).alias("start"), F.max(ts).alias("end"), F.count(F.lit(1)).alias("rows")]
    if step:
        aggs.append(F.sum(step).alias("size"))
    return numbered.groupBy(*keys, label, "_run").agg(*aggs).drop("_run")


def ramp_events(df: DataFrame, value: str, threshold: Column | float, keys: Sequence[str] = ("plant_name",), ts: str = "timestamp",
                tiebreak: Sequence[str] = (), max_gap_hours: float = 1.0, bucket_hours: int = BUCKET_HOURS) -> DataFrame:
    """Ramps of ``value``: runs of rows that all rise (or all fall) by at
    least ``threshold`` against the row before, which is at most
    ``max_gap_hours`` away.  ``keys``, ``direction``, ``start`` and ``end``
    (the first and the last steep row), ``rows`` and ``size``, the sum of the
    steps."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    known = F.col(ts).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    d = df.filter(known).withColumn("_eb", _bucket(ts, bucket_hours))
    w = Window.partitionBy(*keys, "_eb").orderBy(ts, *tiebreak)
    packed = F.struct(F.col(ts).alias("t"), F.col(value).alias("v"))
    tail = F.struct(F.col(ts), *[F.col(c) for c in tiebreak], packed.alias("_packed"))
    ends = d.groupBy(*keys, "_eb").agg(F.max(tail)["_packed"].alias("_tail"))
    ends = ends.select(*keys, "_eb", F.lag("_tail").over(Window.partitionBy(*keys).orderBy("_eb")).alias("_before"))
    j = d.withColumn("_last", F.lag(packed).over(w)).join(ends, [*keys, "_eb"]).withColumn("_prev", F.coalesce("_last", "_before"))
    near = epoch_micros(ts) - epoch_micros(F.col("_prev")["t"]) <= F.lit(int(max_gap_hours * 3_600_000_000))
    change = F.when(near, F.col(value) - F.col("_prev")["v"])
    j = j.withColumn("_step", change).withColumn("direction", F.when(F.col("_step") >= limit, "up").when(F.col("_step") <= -limit, "down"))
    return runs(j.select(*keys, ts, *tiebreak, "_step", "direction"), "direction", keys, ts, tiebreak, "_step", max_gap_hours, bucket_hours)

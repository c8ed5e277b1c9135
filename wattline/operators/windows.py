"""Time-bucketed window primitives.

``Window.partitionBy("plant_name")`` puts a whole plant into one task, and a
global as-of has no partition key at all.  Two primitives split every series
by time instead, so a plant holding a third of all rows still spreads over
many tasks:

* :func:`halo_window` — bounded row frames (lags, rolling stats, bounded
  fills).  Rows are hashed to ``(keys, time bucket)``; the last ``back`` hours
  of each bucket are copied into the next bucket (and the first ``fwd`` hours
  into the previous one) as halo rows, the window runs per bucket, and the
  halo is dropped.  Exact when each key has at most one row per hour and no
  missing hours (the aligned hourly grid), because then ``n`` rows == ``n``
  hours.

* :func:`carry_valid` — unbounded "previous / next non-null value" lookups
  (interpolation, unlimited gaps, as-of).  Inside each bucket a window finds
  the local answer; a per-bucket summary (one row per key and bucket) gets
  carry-in / carry-out values and row offsets from one small window ordered by
  bucket, and is joined back.  Works on irregular series and yields a global
  row number per key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_US_PER_HOUR = 3_600_000_000
NULL_BUCKET = -(1 << 62)
NULL_BUCKETS = 1024  # buckets that a key's rows without a time are dealt over
_NO_BUCKET = NULL_BUCKET - 1


def hour_index(ts: str | Column) -> Column:
    """Whole hours since 1970-01-01 for a naive (session-UTC) timestamp."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(_US_PER_HOUR)).cast("long")


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since epoch as long (exact differences)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def halo_window(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    build: Callable[[Window], list[Column]],
    back: int,
    fwd: int = 0,
    bucket_hours: int = 720,
    index_col: str | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Append the window columns returned by ``build(w)``.

    ``w`` is ``Window.partitionBy(*keys, bucket).orderBy(ts)``; frames built
    on it may look at most ``back`` rows back and ``fwd`` rows ahead.

    Positions are whole hours of ``ts`` (exact on a gap-free hourly grid),
    or, with ``index_col``, a per-key row number (exact on any series; then
    ``bucket_hours`` is the bucket length in rows and ``order`` the sort).
    """
    if back > bucket_hours or fwd > bucket_hours:
        raise ValueError("bucket_hours must cover the largest look-back / look-ahead")
    h = F.col(index_col) if index_col else hour_index(ts)
    b0 = F.floor(h / F.lit(bucket_hours)).cast("long")
    pos = h - b0 * F.lit(bucket_hours)
    copies = [F.lit(0)]
    if back > 0:
        copies.append(F.when(pos >= F.lit(bucket_hours - back), F.lit(1)))
    if fwd > 0:
        copies.append(F.when(pos < F.lit(fwd), F.lit(-1)))
    staged = (
        df.withColumn("_hb0", b0)
        .withColumn("_halo", F.explode(F.array(*copies)))
        .filter(F.col("_halo").isNotNull())
        .withColumn("_hb", F.col("_hb0") + F.col("_halo"))
    )
    w = Window.partitionBy(*keys, "_hb").orderBy(*(order or [ts]))
    out = staged.select("*", *build(w))
    return out.filter(F.col("_halo") == 0).drop("_hb0", "_halo", "_hb")


def q(name: str) -> str:
    """Backtick-quoted identifier for SQL expression strings."""
    return "`" + name.replace("`", "``") + "`"


def _over(keys: Sequence[str], order: str, frame: str) -> str:
    part = f"partition by {', '.join(keys)} " if keys else ""
    return f"over ({part}order by {order} rows between {frame})"


def carry_valid(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    values: dict[str, str],
    tiebreak: Sequence[str] = (),
    bucket_hours: int = 720,
    bucket_col: str = "_cb",
    strict: bool = False,
) -> DataFrame:
    """For each ``name -> column`` add ``_prev_<name>`` / ``_next_<name>``.

    ``_prev_x`` is the last row (current included) where the column is not
    null, ``_next_x`` the first one from the current row on, as
    ``struct(rn long, t timestamp, v)`` where ``rn`` is the 1-based row number
    of that row within its key in ``(ts, *tiebreak)`` order.  ``_rn`` is the
    current row's number.  The bucket column is kept (``bucket_col``) so
    that a following pass on the same keys reuses the partitioning.
    ``strict=True`` excludes the current row (previous / next *other* row).

    Expressions are built as SQL strings: one call into the JVM per column
    instead of dozens (plan construction stays cheap on the driver).
    """
    if bucket_col not in df.columns:
        # rows without a time come first, dealt over sentinel buckets of their own
        spread = f"pmod(xxhash64({', '.join(q(c) for c in df.columns)}), {NULL_BUCKETS})"
        df = df.withColumn(bucket_col, F.expr(
            f"coalesce(cast(floor(unix_micros(cast({q(ts)} as timestamp)) / {_US_PER_HOUR} / {bucket_hours}) as bigint), "
            f"{NULL_BUCKET} + {spread})"))
    qk = [q(k) for k in keys]
    part = [*qk, q(bucket_col)]
    asc = ", ".join([q(ts), *[q(c) for c in tiebreak]])
    desc = ", ".join(f"{c} desc" for c in [q(ts), *[q(c) for c in tiebreak]])
    edge = "1 preceding" if strict else "current row"
    back = _over(part, asc, f"unbounded preceding and {edge}")
    fwd = _over(part, desc, f"unbounded preceding and {edge}")

    def packed(col: str, rn: str = "_lp") -> str:
        return f"case when {q(col)} is not null then named_struct('rn', {rn}, 't', {q(ts)}, 'v', {q(col)}) end"

    local = df.selectExpr("*", f"cast(row_number() {_over(part, asc, 'unbounded preceding and current row')} as bigint) as _lp")
    exprs = []
    for name, col in values.items():
        exprs.append(f"last({packed(col)}, true) {back} as _pv_{name}")
        # "next valid" as the last valid in reversed order: a growing frame
        # that Spark updates incrementally (a shrinking unbounded-following
        # frame is re-aggregated for every row, O(n^2) per partition).
        exprs.append(f"last({packed(col)}, true) {fwd} as _nv_{name}")
    # Referenced twice below (summary + join-back).  Both read the one shuffle
    # by (keys, bucket): the summary refers to every input column (``_every``),
    # so that the two shuffles are the same and the second is reused.
    every = f"max(xxhash64({', '.join(q(c) for c in df.columns)})) as _every"
    local = local.selectExpr("*", *exprs)
    out_cols = [c for c in local.columns if not c.startswith(("_pv_", "_nv_")) and c != "_lp"]

    # Rows with a null key form no series (as a group-by drops null keys):
    # they get empty carries.  A left join with plain equality keeps them
    # (they match no summary row) and keeps local's partitioning.
    ok = [f"{q(k)} is not null" for k in keys if local.schema[k].nullable]
    key_ok = " and ".join(ok) if ok else "true"

    # One row per (key, bucket): row count and the last / first valid entry.
    summary = local.groupBy(*keys, bucket_col).agg(
        F.expr("max(_lp) as _n"), F.expr(every),
        *[F.expr(f"max({packed(col)}) as _sl_{n}") for n, col in values.items()],
        *[F.expr(f"min({packed(col)}) as _sf_{n}") for n, col in values.items()],
    )
    summary = summary.filter("_every is not null").drop("_every")
    before = _over(qk, q(bucket_col), "unbounded preceding and 1 preceding")
    after = _over(qk, f"{q(bucket_col)} desc", "unbounded preceding and 1 preceding")
    summary = summary.selectExpr("*", f"cast(coalesce(sum(_n) {before}, 0) as bigint) as _off")

    def shift(x: str, off: str) -> str:
        return f"case when {x} is not null then named_struct('rn', {off} + {x}.rn, 't', {x}.t, 'v', {x}.v) end"

    glob = []
    for n in values:
        glob += [f"{shift('_sl_' + n, '_off')} as _gl_{n}", f"{shift('_sf_' + n, '_off')} as _gf_{n}"]
    summary = summary.selectExpr(*qk, q(bucket_col), "_off", *glob)
    carries = []
    for n in values:
        carries += [f"last(_gl_{n}, true) {before} as _ci_{n}", f"last(_gf_{n}, true) {after} as _co_{n}"]
    summary = summary.selectExpr(*qk, q(bucket_col), "_off", *carries)

    # The group of a null key gets a key and a bucket that match no row: were it
    # filtered out, the filter would sink below the summary's shuffle and make
    # it another one than local's.
    def named(k: str) -> str:
        kind = local.schema[k].dataType.simpleString()
        return f"coalesce({q(k)}, cast({repr('') if kind == 'string' else 0} as {kind})) as {q(k)}"

    loose = [k for k in keys if local.schema[k].nullable]
    summary = summary.selectExpr(*[named(k) if k in loose else q(k) for k in keys],
                                 f"case when {key_ok} then {q(bucket_col)} else {_NO_BUCKET} end as {q(bucket_col)}",
                                 *[c for c in summary.columns if c not in (*keys, bucket_col)])
    # plain equality on the partition columns: the join reuses local's partitioning
    joined = local.join(summary, on=[*keys, bucket_col], how="left")
    final = [f"case when {key_ok} then _off + _lp end as _rn"]
    for n in values:
        final.append(f"case when {key_ok} then coalesce({shift('_pv_' + n, '_off')}, _ci_{n}) end as _prev_{n}")
        final.append(f"case when {key_ok} then coalesce({shift('_nv_' + n, '_off')}, _co_{n}) end as _next_{n}")
    return joined.selectExpr(*[q(c) for c in out_cols], *final)


def drop_carry(df: DataFrame, bucket_col: str = "_cb") -> DataFrame:
    """Remove the helper columns added by :func:`carry_valid`."""
    helpers = [c for c in df.columns if c.startswith(("_prev_", "_next_")) or c in ("_rn", bucket_col)]
    return df.drop(*helpers)

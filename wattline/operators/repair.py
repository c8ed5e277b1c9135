"""Gap repair: limited interpolation (by time or by row), limited fills.

All operators work per key (plant) in timestamp order and run on
:func:`carry_valid`, so a long gap (or a whole plant) never has to sit in a
single task: the previous / next valid value is found inside a time bucket
and carried across buckets through a small per-bucket summary.

Semantics (forward direction, as in the reproduced pipeline):

* interpolate: the first ``limit`` nulls after a valid value are filled,
  linearly in elapsed time (``method="time"``) or in row position
  (``"linear"``) towards the next valid value; leading nulls stay null;
  trailing nulls (no next value) take the last valid value, again at most
  ``limit`` of them.
* ffill / bfill with limit: carry the last (next) valid value over at most
  ``limit`` consecutive nulls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline import config as C
from wattline.operators.series import row_index
from wattline.operators.windows import carry_valid, halo_window, q


def _us(x: str) -> str:
    return f"unix_micros(cast({x} as timestamp))"


def _interp(c: str, ts: str, limit: int, method: str) -> Column:
    col, prev, nxt = q(c), q(f"_prev_{c}"), q(f"_next_{c}")
    if method == "time":
        num = f"cast({_us(q(ts))} - {_us(prev + '.t')} as double)"
        den = f"cast({_us(nxt + '.t')} - {_us(prev + '.t')} as double)"
    elif method == "linear":
        num = f"cast(_rn - {prev}.rn as double)"
        den = f"cast({nxt}.rn - {prev}.rn as double)"
    else:
        raise ValueError(f"unknown interpolation method {method!r}")
    val = f"{prev}.v + ({nxt}.v - {prev}.v) * try_divide({num}, {den})"
    return F.expr(
        f"case when {col} is not null then {col} when {prev} is null then cast(null as double) "
        f"when _rn - {prev}.rn > {int(limit)} then cast(null as double) when {nxt} is null then {prev}.v "
        f"else coalesce({val}, {prev}.v) end")


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def interpolate(
    df: DataFrame,
    cols: Sequence[str] | dict[str, str],
    keys: Sequence[str] = ("plant_name",),
    ts: str = "timestamp",
    limit: int = C.MAX_GAP_ROWS,
    method: str = "time",
    tiebreak: Sequence[str] = (),
    bucket_hours: int = C.Defaults().carry_bucket_hours,
    keep_bucket: bool = False,
    keep_rn: bool = False,
) -> DataFrame:
    """Limited interpolation of ``cols`` (a list, or ``{col: method}``).

    ``keep_rn`` keeps ``_rn``, the row's position within its key."""
    methods = dict(cols) if isinstance(cols, dict) else {c: method for c in cols}
    methods = {c: m for c, m in methods.items() if c in df.columns}
    if not methods:
        return df
    carried = carry_valid(df, keys, ts, {c: c for c in methods}, tiebreak, bucket_hours)
    out = carried.withColumns({c: _interp(c, ts, limit, m) for c, m in methods.items()})
    out = out.drop(*[f"_prev_{c}" for c in methods], *[f"_next_{c}" for c in methods])
    if not keep_rn:
        out = out.drop("_rn")
    return out if keep_bucket else out.drop("_cb")


def fill_limited(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = ("plant_name",),
    ts: str = "timestamp",
    ffill: int | None = C.FILL_LIMIT_ROWS,
    bfill: int | None = C.FILL_LIMIT_ROWS,
    tiebreak: Sequence[str] = (),
    bucket_hours: int = C.Defaults().carry_bucket_hours,
) -> DataFrame:
    """Forward fill then backward fill, each over at most ``limit`` nulls:
    bounded row frames over the rows' positions, no carry."""
    cols = _present(df, cols)
    if not cols:
        return df
    ranked = row_index(df, keys, ts, tiebreak, "_rn", bucket_hours)
    return fill_by_position(ranked, cols, keys, "_rn", ffill or 0, bfill or 0).drop("_rn")


def ffill_limited(df, cols, limit: int = C.FILL_LIMIT_ROWS, **kw) -> DataFrame:
    return fill_limited(df, cols, ffill=limit, bfill=None, **kw)


def bfill_limited(df, cols, limit: int = C.FILL_LIMIT_ROWS, **kw) -> DataFrame:
    return fill_limited(df, cols, ffill=None, bfill=limit, **kw)


def drop_critical_nulls(df: DataFrame, cols: Sequence[str] = ("generation_mw", "plant_name", "timestamp")) -> DataFrame:
    return df.na.drop(subset=_present(df, cols))


def fill_by_position(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("plant_name",),
                     rn: str = "_rn", ffill: int = C.FILL_LIMIT_ROWS, bfill: int = C.FILL_LIMIT_ROWS,
                     bucket_rows: int = 1 << 18) -> DataFrame:
    """ffill then bfill (limits in rows) given each row's position ``rn``.

    Both are bounded row frames, so this is a halo window over row-number
    buckets: exact on irregular series, one shuffle, no summary pass.  Rows
    without a position (null key) are left as they are."""
    cols = _present(df, cols)

    def build(w):
        ff, bf = w.rowsBetween(-ffill, 0), w.rowsBetween(0, bfill)
        return [F.when(F.col(rn).isNotNull(), F.coalesce(F.col(c), F.last(c, True).over(ff), F.first(c, True).over(bf)))
                .otherwise(F.col(c)).alias(f"_f_{c}") for c in cols]

    out = halo_window(df, keys, rn, build, back=ffill, fwd=bfill, bucket_hours=bucket_rows, index_col=rn, order=[rn])
    return out.withColumns({c: F.col(f"_f_{c}") for c in cols}).drop(*[f"_f_{c}" for c in cols])


def repair_missing(
    df: DataFrame,
    weather_cols: Sequence[str] = C.WEATHER_COLS,
    target: str = "generation_mw",
    keys: Sequence[str] = ("plant_name",),
    ts: str = "timestamp",
    tiebreak: Sequence[str] = (),
    limit: int = C.MAX_GAP_ROWS,
    fill_limit: int = C.FILL_LIMIT_ROWS,
    bucket_hours: int = C.Defaults().carry_bucket_hours,
) -> DataFrame:
    """Weather: time interpolation -> ffill -> bfill; target: linear
    interpolation; then drop rows missing target, plant or time.

    Pass 1 (interpolation, unbounded look-ahead) runs on the bucket carry and
    yields each row's position; pass 2 (fills, bounded to ``fill_limit``
    rows) is a halo window over row-number buckets.
    """
    wcols = _present(df, weather_cols)
    methods = {c: "time" for c in wcols}
    if target in df.columns:
        methods[target] = "linear"
    step1 = interpolate(df, methods, keys, ts, limit, tiebreak=tiebreak,
                        bucket_hours=bucket_hours, keep_rn=True)
    step2 = fill_by_position(step1, wcols, keys, "_rn", fill_limit, fill_limit) if wcols else step1
    return drop_critical_nulls(step2.drop("_rn"), (target, *keys, ts))

"""Data-quality checks as aggregations producing long check tables.

Every check is a handful of aggregate expressions; the whole report rolls up
from one aggregate of the checked frame (:func:`check_cells`).  Results are long
tables ``(check, item, value, threshold, severity, flagged)`` so they union
into one report and roll up with a single aggregation.  ``severity`` is
``issue`` (fails the check where the rule says so) or ``warning``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline import config as C
from wattline.functions.stats import pearson
from wattline.operators.windows import NULL_BUCKET, NULL_BUCKETS, epoch_micros
from wattline.session import materialize

REQUIRED = ("timestamp", "plant_name", "plant_type", "generation_mw", "capacity_mw")

def _row(check: str, item: str | Column, value: Column, threshold: float | None, severity: str,
         flagged: Column, fails: bool) -> Column:
    it = item if isinstance(item, Column) else F.lit(item)
    return F.struct(
        F.lit(check).alias("check"), it.cast("string").alias("item"), value.cast("double").alias("value"),
        F.lit(threshold).cast("double").alias("threshold"), F.lit(severity).alias("severity"),
        flagged.alias("flagged"), (flagged & F.lit(fails)).alias("fails_check"),
    )


def _explode(df: DataFrame, rows: list[Column]) -> DataFrame:
    return df.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# --- one shared aggregation pass --------------------------------------------

def check_cells(df: DataFrame, key: str = "plant_name", ts: str = "timestamp", target: str = "generation_mw",
                capacity: str = "capacity_mw", bucket_hours: int = C.Defaults().carry_bucket_hours) -> DataFrame:
    """One row per (key, time bucket): rows, null counts, repeated times, gaps,
    bound violations and centred moments.  Everything in :func:`check_table`
    rolls up from it.  A time's steps and the sums share one shuffle; rows
    without a time are dealt over buckets of their own."""
    cols = df.columns
    us = epoch_micros(ts)
    spread = F.lit(NULL_BUCKET) + F.pmod(F.xxhash64(*cols), F.lit(NULL_BUCKETS))
    d = df.withColumn("_bucket", F.coalesce(F.floor(us / F.lit(3_600_000_000 * bucket_hours)).cast("long"), spread))
    w = Window.partitionBy(key, "_bucket").orderBy(ts)
    d = d.withColumn("_step", us - F.lag(us).over(w))
    hour = F.lit(3_600_000_000)
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(F.col(ts).isNull()).alias("untimed"), F.count_if(F.col("_step") == 0).alias("repeated"),
            F.count_if(F.col("_step") > hour).alias("gaps"), F.min(us).alias("first"), F.max(us).alias("last")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null__{c}") for c in cols]
    if target in cols and capacity in cols:
        aggs.append(F.count_if(F.col(target) < 0).alias("neg_gen"))
        aggs.append(F.count_if(F.col(target) > F.col(capacity) * F.lit(C.OVERGEN_FACTOR)).alias("over_gen"))
    for c, (lo, hi) in C.WEATHER_RANGES.items():
        if c in cols:
            aggs.append(F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(f"oor__{c}"))
    for name, (cond, other) in _correlated(cols, target).items():
        both = cond & F.col(target).isNotNull() & F.col(other).isNotNull()
        x, y = (F.when(both, F.col(c).cast("double")) for c in (target, other))
        aggs += [F.count_if(cond).alias(f"rows__{name}"), F.count_if(both).alias(f"m__{name}"), F.covar_pop(x, y).alias(f"xy__{name}")]
        for c, v in (("x", x), ("y", y)):
            aggs += [F.avg(v).alias(f"{c}__{name}"), F.var_pop(v).alias(f"{c}{c}__{name}"), F.min(v).alias(f"{c}min__{name}"), F.max(v).alias(f"{c}max__{name}")]
    return d.groupBy(key, "_bucket").agg(*aggs)


def _correlated(cols: Sequence[str], target: str) -> dict[str, tuple[Column, str]]:
    """Correlation checks that the columns allow: name -> (rows, other column)."""
    out = {}
    if "plant_type" in cols and target in cols:
        irr = "surface_solar_radiation_downwards"
        if irr in cols:
            h = F.col("hour") if "hour" in cols else F.hour("timestamp")
            out["solar"] = ((F.col("plant_type") == "solar") & h.between(*C.DAYLIGHT_HOURS), irr)
        if "wind_speed" in cols:
            out["wind"] = (F.col("plant_type") == "wind", "wind_speed")
    return out


def _pooled_pearson(cells: DataFrame, name: str) -> list[Column]:
    """Aggregates over cells for :func:`_pearson_of`: co-moments inside the
    cells plus those of the cells' means about the overall mean."""
    m = F.col(f"m__{name}")
    mean = {c: cells.agg(F.try_divide(F.sum(m * F.col(f"{c}__{name}")), F.sum(m))).scalar() for c in "xy"}
    off = {c: F.col(f"{c}__{name}") - mean[c] for c in "xy"}
    out = [F.sum(m * (F.col(f"{a}{b}__{name}") + off[a] * off[b])).alias(f"c{a}{b}__{name}") for a, b in ("xx", "yy", "xy")]
    return out + [(F.min(f"{c}min__{name}") < F.max(f"{c}max__{name}")).alias(f"v{c}__{name}") for c in "xy"]


def _pearson_of(name: str) -> Column:
    """Pearson correlation from pooled co-moments; NULL for constant input."""
    xx, yy, xy = (F.col(f"c{p}__{name}") for p in ("xx", "yy", "xy"))
    varied = F.col(f"vx__{name}") & F.col(f"vy__{name}") & (xx > 0) & (yy > 0)
    return F.when(varied, F.try_divide(xy, F.sqrt(xx) * F.sqrt(yy)))


def null_profile(df: DataFrame) -> DataFrame:
    """(column, null_count) for every column."""
    prof = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return prof.selectExpr(f"stack({len(df.columns)}, {stack}) as (column, null_count)")


def missing_overall(df: DataFrame, max_pct: float = C.MAX_MISSING_PCT) -> DataFrame:
    ncols = len(df.columns)
    nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    out = df.agg(F.count(F.lit(1)).alias("rows"), nulls.cast("long").alias("missing_cells"))
    pct = F.try_divide(F.col("missing_cells") * F.lit(100.0), F.col("rows") * F.lit(ncols))
    return out.select("rows", F.lit(ncols).alias("columns"), "missing_cells", pct.alias("missing_pct"),
                      (F.coalesce(pct, F.lit(0.0)) <= F.lit(max_pct)).alias("passed"))


def missing_by_column(df: DataFrame, max_pct: float = C.MAX_MISSING_PCT) -> DataFrame:
    prof = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    long = prof.selectExpr("_n", f"stack({len(df.columns)}, {stack}) as (column, null_count)")
    pct = F.try_divide(F.col("null_count") * F.lit(100.0), F.col("_n"))
    return long.select("column", pct.alias("missing_pct"), (pct > F.lit(max_pct)).alias("high_missing"))


def missing_by_plant(df: DataFrame, key: str = "plant_name", max_pct: float = C.MAX_MISSING_PCT) -> DataFrame:
    ncols = len(df.columns)
    nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), nulls.alias("_m"))
    pct = F.try_divide(F.col("_m") * F.lit(100.0), F.col("_n") * F.lit(ncols))
    return g.select(key, pct.alias("missing_pct"), (pct > F.lit(max_pct)).alias("high_missing"))


def duplicate_keys(df: DataFrame, keys: Sequence[str] = ("timestamp", "plant_name")) -> DataFrame:
    """Occurrences beyond the first of each key (partial aggregation first)."""
    g = df.groupBy(*keys).count()
    return g.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicates"))


def gap_summary(df: DataFrame, key: str = "plant_name", ts: str = "timestamp",
                tiebreak: Sequence[str] = (), expected_hours: float = 1.0,
                bucket_hours: int = C.Defaults().carry_bucket_hours) -> DataFrame:
    """Per plant: points, gaps (step > expected), longest gap in hours (0 if none).

    Aggregation only: steps inside each (plant, time bucket) come from a
    ``lag`` window there; steps between consecutive non-empty buckets from a
    small window over the per-bucket first / last timestamps.  No row is
    shuffled by plant alone and nothing is joined back."""
    thr = F.lit(expected_hours * 3600.0)
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    b = F.floor(us(ts) / F.lit(3_600_000_000 * bucket_hours)).cast("long")
    d = df.select(key, ts, *tiebreak).withColumn("_b", b)
    w = Window.partitionBy(key, "_b").orderBy(ts, *tiebreak)
    d = d.withColumn("_dt", (us(ts) - F.unix_micros(F.lag(F.col(ts).cast("timestamp")).over(w))).cast("double") / 1e6)
    per_bucket = d.groupBy(key, "_b").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_dt") > thr).alias("_g"),
        F.max(F.when(F.col("_dt") > thr, F.col("_dt"))).alias("_m"),
        F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    wb = Window.partitionBy(key).orderBy("_b")
    per_bucket = per_bucket.withColumn(
        "_xdt", (us("_first") - F.unix_micros(F.lag(F.col("_last").cast("timestamp")).over(wb))).cast("double") / 1e6)
    cross = F.col("_xdt") > thr
    return per_bucket.groupBy(key).agg(
        F.sum("_n").cast("long").alias("total_points"),
        (F.sum("_g") + F.count_if(cross)).cast("long").alias("gaps_count"),
        (F.coalesce(F.greatest(F.max("_m"), F.max(F.when(cross, F.col("_xdt")))), F.lit(0.0)) / 3600.0).alias("max_gap_hours"),
    )


def gap_flag(df: DataFrame, key: str = "plant_name", ts: str = "timestamp", tiebreak: Sequence[str] = (),
             share: float = C.GAP_SHARE, scope: str = "all") -> DataFrame:
    """Plants whose gap count exceeds ``share`` of all rows (``scope='all'``,
    the literal rule) or of the plant's own rows (``scope='plant'``)."""
    gs = gap_summary(df, key, ts, tiebreak)
    if scope == "all":
        # total row count as a scalar subquery (no join)
        limit = df.select(F.count(F.lit(1))).scalar() * F.lit(share)
    else:
        limit = F.col("total_points") * F.lit(share)
    return gs.select(key, "gaps_count", (F.col("gaps_count") > limit).alias("excessive_gaps"))


def min_points_check(df: DataFrame, key: str = "plant_name", min_points: int = C.MIN_DATA_POINTS) -> DataFrame:
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("points"))
    return g.select(key, "points", (F.col("points") >= F.lit(min_points)).alias("passed"))


def generation_bounds(df: DataFrame, target: str = "generation_mw", capacity: str = "capacity_mw") -> DataFrame:
    return df.agg(
        F.count_if(F.col(target) < 0).alias("negative_count"),
        F.count_if(F.col(target) > F.col(capacity) * F.lit(C.OVERGEN_FACTOR)).alias("over_capacity_count"),
    )


def weather_bounds(df: DataFrame) -> DataFrame:
    present = [(c, lo, hi) for c, (lo, hi) in C.WEATHER_RANGES.items() if c in df.columns]
    prof = df.agg(*[F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(c) for c, lo, hi in present])
    stack = ", ".join(f"'{c}', cast({lo} as double), cast({hi} as double), `{c}`" for c, lo, hi in present)
    return prof.selectExpr(f"stack({len(present)}, {stack}) as (column, min_value, max_value, out_of_range)")


def corr_check(df: DataFrame, which: str, target: str = "generation_mw") -> DataFrame:
    """Pearson correlation check: ``solar`` (daylight solar rows vs irradiance,
    warn < 0.3) or ``wind`` (wind rows vs wind speed, warn < 0.5)."""
    h = F.col("hour") if "hour" in df.columns else F.hour("timestamp")
    if which == "solar":
        cond = (F.col("plant_type") == "solar") & h.between(*C.DAYLIGHT_HOURS)
        other, thr = "surface_solar_radiation_downwards", C.SOLAR_CORR_MIN
    else:
        cond = F.col("plant_type") == "wind"
        other, thr = "wind_speed", C.WIND_CORR_MIN
    g = df.agg(F.count_if(cond).alias("rows"), pearson(F.when(cond, F.col(target)), F.when(cond, F.col(other))).alias("correlation"))
    return g.select("rows", "correlation", F.lit(thr).alias("threshold"),
                    (F.col("correlation") < F.lit(thr)).alias("weak"))


def structure_check(df: DataFrame, required: Sequence[str] = REQUIRED, ts: str = "timestamp") -> DataFrame:
    """Missing required columns, timestamp type, emptiness (one tiny job)."""
    spark = df.sparkSession
    missing = [c for c in required if c not in df.columns]
    ts_ok = ts in df.columns and dict(df.dtypes)[ts] in ("timestamp", "timestamp_ntz")
    empty = df.limit(1).select(F.count(F.lit(1))).scalar() == 0
    base = spark.createDataFrame([(",".join(missing), ts_ok)], "missing_columns string, timestamp_is_datetime boolean")
    out = base.withColumn("empty", empty)
    return out.select("missing_columns", "timestamp_is_datetime", "empty",
                      ((F.col("missing_columns") == "") & ~F.col("empty")).alias("passed"))


def check_table(df: DataFrame, key: str = "plant_name", ts: str = "timestamp", tiebreak: Sequence[str] = (),
                target: str = "generation_mw") -> DataFrame:
    """All checks as one long table, rolled up from one aggregate of the
    frame (:func:`check_cells`, a few rows for each plant, written once; the
    frame itself is read once)."""
    cols = df.columns
    cells = materialize(check_cells(df, key, ts, target))
    plain = [c for c in cells.columns if c in ("n", "repeated", "neg_gen", "over_gen") or c.startswith(("null__", "oor__", "rows__"))]
    counts = set(plain)
    untimed = cells.groupBy(key).agg(F.sum("untimed").alias("u")).agg(F.sum(F.greatest(F.col("u") - 1, F.lit(0)))).scalar()
    pooled = [e for name in _correlated(cols, target) for e in _pooled_pearson(cells, name)]
    prof = cells.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in plain], *pooled) \
        .withColumn("_dup", F.col("repeated") + F.coalesce(untimed, F.lit(0)))  # times of a plant that occur again, no time being one of them
    ncols = len(cols)
    rows = []
    total_null = sum((F.col(f"null__{c}") for c in cols), F.lit(0))
    overall = F.try_divide(total_null * F.lit(100.0), F.col("n") * F.lit(ncols))
    rows.append(_row("completeness", "overall_missing_pct", overall, C.MAX_MISSING_PCT, "issue",
                     F.coalesce(overall > C.MAX_MISSING_PCT, F.lit(False)), True))
    for c in cols:
        pct = F.try_divide(F.col(f"null__{c}") * F.lit(100.0), F.col("n"))
        rows.append(_row("completeness", F.lit(f"column:{c}"), pct, C.MAX_MISSING_PCT, "warning",
                         F.coalesce(pct > C.MAX_MISSING_PCT, F.lit(False)), False))
    if "neg_gen" in counts:
        rows.append(_row("physical", "negative_generation", F.col("neg_gen"), 0.0, "issue", F.col("neg_gen") > 0, False))
        rows.append(_row("physical", "over_generation", F.col("over_gen"), 0.0, "warning", F.col("over_gen") > 0, False))
    for c in C.WEATHER_RANGES:
        if f"oor__{c}" in counts:
            rows.append(_row("physical", F.lit(f"range:{c}"), F.col(f"oor__{c}"), 0.0, "warning", F.col(f"oor__{c}") > 0, False))
    for name, item, least in (("solar", "solar_irradiance_correlation", C.SOLAR_CORR_MIN), ("wind", "wind_speed_correlation", C.WIND_CORR_MIN)):
        if f"rows__{name}" in counts:
            corr = _pearson_of(name)
            rows.append(_row("physical", item, corr, least, "warning",
                             F.coalesce((F.col(f"rows__{name}") > 0) & (corr < least), F.lit(False)), False))
    rows.append(_row("temporal", "duplicate_keys", F.col("_dup"), 0.0, "warning", F.col("_dup") > 0, False))
    rows.append(_row("structure", "empty", (F.col("n") == 0).cast("double"), 0.0, "issue", F.col("n") == 0, True))
    missing = [c for c in REQUIRED if c not in cols]
    if missing:
        rows.append(_row("structure", F.lit("missing_columns:" + ",".join(missing)), F.lit(float(len(missing))), 0.0,
                         "issue", F.lit(True), True))
    long = _explode(prof, rows)

    # per-plant rows: completeness warnings and gaps between the plant's times
    plants = cells.groupBy(key).agg(F.sum("n").alias("n"), *[F.sum(f"null__{c}").alias(f"null__{c}") for c in cols])
    pct = F.try_divide(total_null * F.lit(100.0), F.col("n") * F.lit(ncols))
    mp = plants.select(_row("completeness", F.concat(F.lit("plant:"), F.col(key)), pct, C.MAX_MISSING_PCT, "warning",
                            F.coalesce(pct > C.MAX_MISSING_PCT, F.lit(False)), False).alias("r")).select("r.*")
    limit = cells.agg(F.sum("n")).scalar() * F.lit(C.GAP_SHARE)
    between = F.col("first") - F.lag("last").over(Window.partitionBy(key).orderBy("_bucket"))
    gaps = cells.withColumn("_between", between).groupBy(key).agg(
        (F.sum("gaps") + F.count_if(F.col("_between") > 3_600_000_000)).cast("long").alias("gaps_count"))
    gf = gaps.select(
        _row("temporal", F.concat(F.lit("gaps:"), F.col(key)), F.col("gaps_count"), C.GAP_SHARE, "warning",
             F.col("gaps_count") > limit, False).alias("r")).select("r.*")
    return long.unionByName(mp).unionByName(gf)


def check_messages(checks: DataFrame) -> DataFrame:
    """One line per flagged check row: (severity, message), the message
    prefixed by its check."""
    side = F.when(F.col("item").endswith("_correlation"), F.lit(" below")).otherwise(F.lit(" above"))
    shown = F.concat(F.col("check"), F.lit(": "), F.col("item"), side, F.lit(" its limit"))
    return checks.filter("flagged").select("severity", shown.alias("message"))


def validation_summary(checks: DataFrame) -> DataFrame:
    """overall_passed = no failing check; totals of flagged issues / warnings."""
    return checks.agg(
        (~F.coalesce(F.max(F.col("fails_check").cast("int")) == 1, F.lit(False))).alias("overall_passed"),
        F.count_if(F.col("flagged") & (F.col("severity") == "issue")).alias("total_issues"),
        F.count_if(F.col("flagged") & (F.col("severity") == "warning")).alias("total_warnings"),
    )


def issue_head(checks: DataFrame, n: int = 5, severity: str = "issue") -> DataFrame:
    """First ``n`` flagged items of a severity (ordered by check, item) and
    the number of remaining ones."""
    f = checks.filter(F.col("flagged") & (F.col("severity") == severity))
    head = f.orderBy("check", "item").limit(n)  # distributed top-k
    total = f.select(F.count(F.lit(1))).scalar()
    ranked = head.withColumn("rank", F.row_number().over(Window.orderBy("check", "item")))  # <= n rows
    return ranked.select("rank", "check", "item", "value",
                         F.greatest(total - F.lit(n), F.lit(0)).cast("long").alias("more"))


def dataset_summary(df: DataFrame, key: str = "plant_name", ts: str = "timestamp") -> DataFrame:
    """Shape, distinct plants, plant types, date range."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.countDistinct(key).alias("plants"),
        F.concat_ws(",", F.sort_array(F.collect_set("plant_type"))).alias("plant_types"),
        F.min(ts).alias("start"),
        F.max(ts).alias("end"),
    )

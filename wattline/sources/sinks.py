"""Sinks: partitioned Parquet feature tables, per-plant files, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


MONTH = "year_month"


def write_features(df: DataFrame, path: str, partition_by: Sequence[str] = ("plant_name",), ts: str = "timestamp",
                   mode: str = "overwrite", dynamic: bool = False) -> None:
    """Partitioned by plant and month: rows are dealt by (plant, month), so a
    folder is one file and a long plant many tasks; a scan for some plants or
    months reads only their folders.  Rows are sorted by time inside a file.
    ``dynamic`` replaces only the folders that ``df`` has rows for."""
    parts = [*partition_by, MONTH]
    monthly = df.withColumn(MONTH, F.date_format(ts, "yyyy-MM"))
    monthly.repartition(*parts).sortWithinPartitions(*parts, ts).write.mode(mode) \
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static").partitionBy(*parts).parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = ("plant_type", "plant_name"),
                      fmt: str = "parquet", mode: str = "overwrite", files_per_folder: int = 4) -> None:
    """One folder per plant type / plant; the union of folders is the combined
    table.  Rows are dealt by folder and a hash into at most
    ``files_per_folder`` files each, so that a large plant is several tasks
    and a small one does not get a file from every task."""
    part = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_folder))
    w = df.repartition(*partition_by, part).write.mode(mode).partitionBy(*partition_by).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Report lines as JSON lines."""
    report.write.mode(mode).json(path)

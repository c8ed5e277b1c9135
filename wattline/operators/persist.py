"""Save / load fitted state: Spark ML pipelines and small parameter tables
(quantile bins, ensemble weights, scaler statistics) in one folder."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def save_model(path: str, tables: dict[str, DataFrame] | None = None, pipeline=None, meta: dict | None = None,
               spark: SparkSession | None = None) -> None:
    """``path/tables/<name>`` Parquet tables, ``path/pipeline`` Spark ML
    model, ``path/meta`` one JSON row (written by Spark: works on any
    shared file system / object store the session can write)."""
    tables = tables or {}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/tables/{name}")
    if pipeline is not None:
        pipeline.write().overwrite().save(f"{path}/pipeline")
    session = spark or (next(iter(tables.values())).sparkSession if tables else SparkSession.getActiveSession())
    doc = {"tables": sorted(tables), "pipeline": pipeline is not None, **(meta or {})}
    session.createDataFrame([(json.dumps(doc),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_model(spark: SparkSession, path: str):
    """-> (tables dict, pipeline model or None, meta dict)."""
    doc = json.loads(spark.read.text(f"{path}/meta").first()[0])
    tables = {n: spark.read.parquet(f"{path}/tables/{n}") for n in doc["tables"]}
    pipeline = None
    if doc.get("pipeline"):
        from pyspark.ml import PipelineModel
        pipeline = PipelineModel.load(f"{path}/pipeline")
    return tables, pipeline, doc

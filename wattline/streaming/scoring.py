"""Scoring arriving readings with a saved model, each micro-batch exactly once.

A micro-batch is scored with the tables that :func:`operators.persist.save_model`
has written and goes to a folder of its own, named by the batch's number and
overwritten as a whole.  A batch that is delivered again after a failure
(Structured Streaming repeats the last one that was not committed) replaces
its own folder, so that nothing is written twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.operators import forecasting as FC
from wattline.operators import learners as L
from wattline.operators.persist import load_model

BATCH = "batch_id"


def score(rows: DataFrame, tables: dict[str, DataFrame], meta: dict) -> DataFrame:
    """``rows`` with P10, P50 and P90 of a saved model, batch or stream alike.

    ``meta["kind"]``: ``bins`` (a table of quantile bins over ``meta["keys"]``)
    or ``linear`` (weights over ``meta["features"]``, point forecasts only)."""
    if meta["kind"] == "bins":
        return FC.predict_quantile_bins(FC.add_month_hour(rows), tables["bins"], meta["keys"]).drop("month", "hour")
    if meta["kind"] == "linear":
        none = F.lit(None).cast("double")
        return L.predict_linear(rows, tables["weights"], meta["keys"], meta["features"]).withColumns({"P10": none, "P90": none})
    raise ValueError(f"no model of kind {meta['kind']!r}")


def batch_writer(model_path: str, path: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: scores a micro-batch and overwrites the folder of its number."""
    def write(rows: DataFrame, batch_id: int) -> None:
        tables, _, meta = load_model(rows.sparkSession, model_path)
        score(rows, tables, meta).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
    return write


def start_scoring(stream: DataFrame, model_path: str, path: str, checkpoint: str, trigger_seconds: int | None = None):
    """Score ``stream`` into ``path`` until stopped; without a trigger, what
    is there now, then end."""
    w = stream.writeStream.foreachBatch(batch_writer(model_path, path)).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=f"{trigger_seconds} seconds") if trigger_seconds else w.trigger(availableNow=True)).start()


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """All scored rows, with the number of their batch."""
    return spark.read.option("basePath", path).parquet(f"{path}/{BATCH}=*")

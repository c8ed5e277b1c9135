"""Registered queries: ``name -> (spark_fn(spark, sf_dir), oracle_sql | None)``.

Every query reads the driver's tables (through the events adapter for the
domain tables) and runs over the whole input.  ``finalize`` rounds doubles
as ``round(x + 1e-9, 6)``, mirrored by ``oracle.wrap`` on the DuckDB side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.session import prepare_session
from wattline.sources.adapter import adapter_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def finalize(df: DataFrame) -> DataFrame:
    """Round double columns the way the oracle does (comparison contract)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double") + F.lit(1e-9), 6).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare_session(spark)
            return finalize(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def tables(spark: SparkSession, sf_dir: str):
    """(generation, weather) from the adapter."""
    return adapter_tables(spark, sf_dir)


def _load_all():
    # import modules that register queries
    from wattline.plans import q_core, q_eval, q_learn, q_misc, q_quality, q_report  # noqa: F401

"""Training-data operators (scoring, dedup, extraction, packing, search).

Nothing outside ``wattline.llm`` imports it."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

_SHIPPED: set[str] = set()


def tidy() -> None:
    """Hand freed memory back to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidied(task: Callable) -> Callable:
    """``task``, a generator for ``mapInArrow``, with a :func:`tidy` after it, when its variables are gone."""
    def run(batches):
        yield from task(batches)
        tidy()

    return run


def shipped(df: DataFrame) -> DataFrame:
    """``df``, once the package's source has been handed to its session's executors.

    The operators' task functions import the package there; Spark's file
    server passes on the archive, once for each application."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(), f"wattline-{uuid.uuid4().hex[:8]}.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("wattline", os.path.relpath(full, package)))
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)
    return df

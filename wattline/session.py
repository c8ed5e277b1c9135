"""Session helpers: build a session for tests/bench, and adapt a given one."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_STAGES: list[str] = []


def get_spark(master: str = "local[8]", app: str = "wattline", shuffle_partitions: int = 8,
              driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare_session(spark)
    return spark


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin naive-time semantics and make sure a checkpoint folder exists.

    The cluster's ``spark.checkpoint.dir`` is respected; only when it is
    unset (local tests) a scratch folder is created.
    """
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Uses the context's checkpoint dir or ``spark.checkpoint.dir``; only a
    local-mode session without either gets a scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not conf_dir:
        if not (sc.master or "").startswith("local"):
            # a machine-local folder would break reliable checkpoints on a cluster
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder shared by all executors")
        conf_dir = tempfile.mkdtemp(prefix="wattline-ckpt-")  # local mode (tests, bench) only
        spark.conf.set(_CHECKPOINT_KEY, conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def stage_path(spark: SparkSession, name: str = "stage") -> str:
    """A new folder in the shared checkpoint folder, which
    :func:`discard_stages` deletes."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/wattline-{name}-{uuid.uuid4().hex}"
    _STAGES.append(path)
    return path


def materialize(df):
    """``df`` written as Parquet to the session's shared checkpoint folder and
    read back: computed once for all who read it, columnar and prunable, and
    safe from lost executors.  Meant for aggregates that several branches of
    a plan read."""
    path = stage_path(df.sparkSession)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


def discard_stages(spark: SparkSession) -> int:
    """Delete the folders that :func:`stage_path` has given so far; call it
    once the results built on them have been written or collected."""
    jvm, done = spark.sparkContext._jvm, 0
    while _STAGES:
        path = jvm.org.apache.hadoop.fs.Path(_STAGES.pop())
        done += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return done

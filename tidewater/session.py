"""Session construction and the shared work folder."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Shuffles start wide and AQE coalesces them to ~128 MB partitions; tests
    # and the bench pass a small spark.sql.shuffle.partitions explicitly.
    "spark.sql.shuffle.partitions": "2000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "134217728",
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Partitioned version writes keep one file per change kind open instead of sorting.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def build_session(master: str = "local[*]", app: str = "tidewater", conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set to shared storage (an error
    otherwise). Only in local mode, when it is unset, is a private folder
    created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder on shared storage; "
                             "a machine-local folder is not usable on a cluster")
        d = tempfile.mkdtemp(prefix="tidewater-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the work folder."""
    return f"{work_dir(spark)}/tidewater/{name}-{uuid.uuid4().hex[:12]}"


_COALESCE_CACHED = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
_settings = threading.Lock()


def persist_coalesced(df: DataFrame) -> DataFrame:
    """``df.persist()`` in the partitions that AQE makes of its last shuffle.

    Spark otherwise keeps all ``spark.sql.shuffle.partitions`` of a cached plan, however
    few its rows, and each later pass over it starts as many tasks. The setting is
    read when a plan is cached, so it is put back at once."""
    conf = df.sparkSession.conf
    with _settings:
        before = conf.get(_COALESCE_CACHED, None)
        conf.set(_COALESCE_CACHED, "true")
        try:
            return df.persist()
        finally:
            if before is None:
                conf.unset(_COALESCE_CACHED)
            else:
                conf.set(_COALESCE_CACHED, before)

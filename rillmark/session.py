"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: All stores of an executor share this much native memory; without it each has buffers of its own, whatever their number.
BOUNDED_CONF, BOUND_MB_CONF = (f"spark.sql.streaming.stateStore.rocksdb.{c}" for c in ("boundedMemoryUsage", "maxMemoryUsageMB"))
BOUND_MB = "1000"
#: What is sent to a Python worker at once, beside the bound on its rows: a row may hold many packed ones.
ARROW_BYTES_CONF, ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "32m"


def build_session(app_name: str = "rillmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and the RocksDB state store."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        PROVIDER_CONF: ROCKSDB_PROVIDER,
        BOUNDED_CONF: "true",
        BOUND_MB_CONF: BOUND_MB,
        ARROW_BYTES_CONF: ARROW_BYTES,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    A machine-local folder is used only in local mode, where driver and
    executors are one process; on a cluster an unset folder is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = os.path.join(tempfile.gettempdir(), "rillmark-scratch")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable: keep a configured folder, else set our own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or scratch_dir(spark, "lineage"))

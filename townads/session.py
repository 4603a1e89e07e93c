"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Retained micro-batches and the tolerated lateness of the two live jobs (fixed values).
BATCHES_TO_RETAIN = "10"
LATENESS = "5 seconds"


def build_session(app: str = "townads", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``extra`` uses ``__`` for the dots of a key."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .config("spark.sql.streaming.minBatchesToRetain", BATCHES_TO_RETAIN)
    )
    if master:
        builder = builder.master(master)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_root: str | None = None


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder path for checkpoints and intermediate tables.

    It lies under ``spark.checkpoint.dir``, which every executor of a cluster can reach. Only a
    local-mode session without that setting gets a temporary folder, since there all tasks share
    one machine.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (spark.conf.get("spark.master", "") or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="townads-")
        root = _local_root
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"

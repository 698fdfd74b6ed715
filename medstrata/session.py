"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

CHECKPOINT_DIR_KEY = "spark.checkpoint.dir"

# Instants are stored and compared in UTC; the skew settings let the engine
# split an oversized join partition even when that costs one more exchange.
_SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_LOCAL_FALLBACK: dict[str, str] = {}


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to ``spark`` and return it."""
    for key, value in _SESSION_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local-mode session, where driver and executors are one process, may
    fall back to a temporary folder, one per application.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_DIR_KEY, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(
            f"set {CHECKPOINT_DIR_KEY} to a folder that all executors share"
        )
    if context.applicationId not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[context.applicationId] = tempfile.mkdtemp(prefix="medstrata-")
    return _LOCAL_FALLBACK[context.applicationId]


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder (created by its first writer)."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Submit independent Spark jobs side by side, so short ones fill idle executors."""
    bound = [inheritable_thread_target(spark)(job) for job in jobs]
    with ThreadPoolExecutor(max_workers=max(1, len(bound))) as pool:
        return [future.result() for future in [pool.submit(job) for job in bound]]

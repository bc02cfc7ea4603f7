"""Session helpers for tests and the benchmark, and shared scratch space.

Library operators never build a session: the caller owns it. ``local_session``
exists for tests and ``bench.py`` only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "aeris") -> SparkSession:
    """A local session with the settings the engine is designed for.

    AQE on (runtime coalescing, skew-join splitting, broadcast conversion from
    measured sizes), UI off, session zone UTC like the original job.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(executors: int = 1000, cores_per_executor: int = 8) -> dict[str, str]:
    """Settings this engine is designed for on a large cluster (apply at
    session build; the library itself never sets them).

    * AQE decides shuffle sizes at runtime: start with many shuffle partitions
      (~3 per core) and let it coalesce to ~256 MB each, split skewed partitions
      of joins, and convert to broadcast from measured sizes.
    * Scan splits of 256 MB keep per-task memory flat for large Parquet files.
    * Dynamic partition overwrite makes fact loads replace only their days.
    * The RocksDB state store keeps streaming state off the JVM heap.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(3 * executors * cores_per_executor),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The cluster names it, and it is never overridden. In a local session, whose
    executors are the driver's own threads, a folder of our own is set when it
    is unset; on a cluster that would be a folder of one machine, so an unset
    ``spark.checkpoint.dir`` is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="aeris-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder name under the shared checkpoint folder.

    Used for landed files, warehouse tables and streaming checkpoints of the
    demonstration queries, so that every executor of a cluster can reach them.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/aeris-{label}-{uuid.uuid4().hex[:12]}"


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme (for code that must touch the local disk in tests)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)

"""Session helpers: a tuned local/cluster session and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Event times are TIMESTAMP_NTZ throughout, so results do not depend on the
# session zone; UTC is still pinned so that LTZ values printed in logs read the same everywhere.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition overwrite replaces only the partitions a write touches (incremental gold refresh).
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # Checkpoint files of materialized batches are removed once their DataFrames are garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Streaming state (dedup keys, open hourly windows) lives in RocksDB, off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Sizing for a cluster run over ``input_bytes`` of input on ``total_cores`` executor cores.

    Shuffle partitions are sized so that each reducer gets about ``target_partition_bytes`` of the largest
    shuffle (the flattened bronze/silver rows, roughly the input size) and never fewer than two waves of
    cores; AQE then coalesces small partitions and splits skewed ones at run time. Scan splits use the same
    target so map tasks stay well inside executor memory.
    """
    by_size = -(-int(input_bytes) // target_partition_bytes)
    partitions = max(2 * int(total_cores), by_size)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        # Broadcast only what is certainly small; larger sides take the shuffled path.
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ridepulse", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder (``spark.checkpoint.dir``).

    On a cluster this setting names a shared file system location and is used as is (and is required). Only
    in local mode, when it is unset (tests), is a fresh local folder created and registered.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no local SparkContext
        if path:
            return path
        raise RuntimeError("set spark.checkpoint.dir on the server to a folder on a shared file system")
    path = path or sc.getConf().get("spark.checkpoint.dir", None)
    if path:
        return path
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        # A machine-local folder would not be readable by other executors.
        raise RuntimeError("set spark.checkpoint.dir to a folder on a shared file system")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ridepulse-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared scratch folder for one run's tables."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")

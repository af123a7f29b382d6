"""Session helpers: the shared folder for written intermediates and cluster sizing."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

_own_roots: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own; on
    a cluster the setting is required, because a machine-local folder would be lost
    with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _own_roots:
        _own_roots[app] = tempfile.mkdtemp(prefix="strataflow-")
    return _own_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created or deleted."""
    return f"{shared_dir(spark)}/strataflow/{name}-{uuid.uuid4().hex}"


def cluster_conf(input_bytes: int, *, shuffle_partition_mb: int = 200, scan_split_mb: int = 256) -> dict[str, str]:
    """Session settings for a load of ``input_bytes``.

    The one wide step (de-duplication) shuffles at most its input, so the initial
    partition count is the input over the wanted partition size; adaptive execution
    merges what the map-side reduction made small. A shuffle keeps one block per map
    and reduce task, so both counts are bounded: at 100 TB that is 100,000 scan tasks
    of 1 GB and 32,000 reduce tasks of 3 GB at most, which sort with spilling. Text
    columns take half the space with zstd as with the default codec, at equal speed.
    """
    shuffles = min(max(math.ceil(input_bytes / (shuffle_partition_mb << 20)), 8), 32_000)
    split_mb = max(scan_split_mb, math.ceil(input_bytes / 100_000 / (1 << 20)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{shuffle_partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffles),
        "spark.sql.files.maxPartitionBytes": f"{split_mb}m",
        "spark.sql.parquet.compression.codec": "zstd",
    }

"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Raw drops are many small files: charge little for opening one, so a task takes
    # hundreds of them instead of a few dozen.
    "spark.sql.files.openCostInBytes": str(256 * 1024),
    # Size that rebalanced writes split and gather files to.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

BYTES_PER_SHUFFLE_PARTITION = 256 * 1024 * 1024

_local_work_dir: str | None = None


def session_builder(app_name: str = "coinweir", input_bytes: int | None = None) -> SparkSession.Builder:
    """A builder with the package's settings. `input_bytes`, the size of what a job reads,
    sets how finely shuffles start out; adaptive execution then only merges partitions."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if input_bytes is not None:
        partitions = max(200, -(-input_bytes // BYTES_PER_SHUFFLE_PARTITION))
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", partitions)
    return builder


def work_dir(spark: SparkSession) -> str:
    """A new folder path for intermediate tables.

    It lies in the folder the cluster names in `spark.checkpoint.dir`. Only a local
    master, where every task shares this machine's disk, falls back to a temporary one.
    """
    global _local_work_dir
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _local_work_dir is None:
            _local_work_dir = tempfile.mkdtemp(prefix="coinweir-")
            atexit.register(shutil.rmtree, _local_work_dir, ignore_errors=True)
        shared = _local_work_dir
    return f"{shared.rstrip('/')}/coinweir-{uuid.uuid4().hex}"

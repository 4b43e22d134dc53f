"""Session helpers: a configured SparkSession and a shared scratch location."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "hirelake",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set to shared storage.  Only when it is
    unset (local tests) is a private folder created and registered.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder: intermediates written "
                                   "to a machine-local folder are lost with the executor that wrote them")
            root = tempfile.mkdtemp(prefix="hirelake-ckpt-")
            spark.conf.set("spark.checkpoint.dir", root)
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one written intermediate."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so plain-Python helpers can inspect a local path."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


def partition_settings(input_bytes: int, target_bytes: int = 256 * 1024 * 1024,
                       min_partitions: int = 200) -> dict[str, str]:
    """Session settings sized to the data, for cluster runs.

    Scan splits and post-shuffle partitions both aim at ``target_bytes`` so a
    task's working set fits in executor memory (sorts and hash tables spill
    beyond it).  The initial shuffle width is set from the input size; AQE then
    coalesces small partitions and splits skewed ones at run time.
    Example: 100 TB of input -> about 400 000 initial shuffle partitions.
    """
    width = max(min_partitions, -(-int(input_bytes) // int(target_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_bytes),
    }

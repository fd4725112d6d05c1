"""Session helpers: a local session for tests/bench and the shared scratch folder.

Library functions never build their own session; they take the caller's.
Lineage is cut with ``DataFrame.checkpoint()`` or a table written under the
folder the cluster names in ``spark.checkpoint.dir``.  Only when that setting is
missing (local tests) do we pick a folder of our own.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tablepipe") -> SparkSession:
    """A local session tuned like the cluster one, minus the cluster."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TABLEPIPE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tp-warehouse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set one only if it is unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # Only reached in tests / local runs: no cluster-wide folder is named.
        conf_dir = tempfile.mkdtemp(prefix="tp-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tablepipe/{name}-{uuid.uuid4().hex[:12]}"


def shared_root(spark: SparkSession) -> str:
    """A folder that outlives the session: the one named in ``spark.checkpoint.dir``
    (the session's own scratch folder in local runs that name none)."""
    return (spark.conf.get("spark.checkpoint.dir", None) or checkpoint_root(spark)).rstrip("/")


def recommended_conf(input_bytes: float, total_cores: int) -> dict[str, str]:
    """Session settings sized for a load of ``input_bytes`` on ``total_cores``.

    * scan splits of 128 MB, 256 MB from 10 TB up (fewer, larger tasks keep the
      task count and driver bookkeeping in check at 100 TB);
    * shuffle partitions so each holds about 200 MB before AQE coalesces them,
      but at least two waves of the cluster's cores;
    * AQE with partition coalescing and skew-join splitting (a key holding a
      third of the rows is split at run time);
    * broadcast only below Spark's size check (statistics-based threshold).
    """
    split = 256 * 1024 ** 2 if input_bytes >= 10 * 1024 ** 4 else 128 * 1024 ** 2
    partitions = max(2 * total_cores, int(math.ceil(input_bytes / (200 * 1024 ** 2))))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 ** 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 ** 2),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str], overwrite: bool = False) -> None:
    """Set the given SQL settings, leaving ones the session already has unless
    ``overwrite``."""
    for k, v in conf.items():
        if overwrite or spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)

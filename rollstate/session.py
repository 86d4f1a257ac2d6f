"""Session defaults and the shared scratch folder.

On a cluster, ``spark.checkpoint.dir`` names a shared folder (HDFS, object store) that every executor
and the driver can reach.  Everything this library writes as an intermediate (scratch tables,
lineage cuts) goes below it.  Only when it is unset, as in local tests, do we set one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults applied by ``builder`` unless the caller or cluster already set them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # A long-running driver (streams, many small batch jobs) keeps only recent job history.
    "spark.sql.ui.retainedExecutions": "100",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
}


def builder(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession.Builder:
    b = SparkSession.builder.appName("rollstate")
    if master:
        b = b.master(master)
    for k, v in {**DEFAULTS, **conf}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a fresh local folder only on a ``local`` master without one.

    Elsewhere a machine's own folder would not be shared, so an unset ``spark.checkpoint.dir`` raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="rollstate-ckpt-")  # unset: local/test session only
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_dir(spark: SparkSession, label: str = "scratch") -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/rollstate/{label}-{uuid.uuid4().hex[:12]}"

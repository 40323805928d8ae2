"""Session construction and the shared folder used to cut lineage.

Iterative operators (PageRank, SCC) and round-trip sinks need a folder every
executor can reach.  The cluster names it in ``spark.checkpoint.dir``; we read
it from the session and only fall back to a fresh temporary folder when the
master is local (tests, laptops).  On a cluster without that setting we fail
loudly instead of writing to one machine's disk.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # iterative operators checkpoint every few iterations; let Spark delete
    # checkpoint files nothing references any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "pulsegraph",
    shuffle_partitions: int = 8,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session (set only if unset)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="pulsegraph-ckpt-", dir="/tmp"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/...) "
        "that all executors can reach"
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint root for round-trip writes."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")

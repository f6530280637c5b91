"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; the cluster's own values win where set.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Capturing the Python call site of every Column call costs ~1-3 ms
    # per call while building plans; off in our own sessions.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "leadflow", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster use the provided session instead."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("LEADFLOW_DRIVER_MEMORY", "4g")))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Every intermediate table we write lives under it.  Only a local master
    (tests, a laptop) may leave it unset and gets a fresh ``mktemp`` folder;
    on any other master that folder would exist on one machine only, so an
    unset value is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share "
                             f"(master is {master})")
        d = tempfile.mkdtemp(prefix="leadflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder, in that folder's own
    filesystem (the scheme is kept)."""
    tail = list(parts) + ([uuid.uuid4().hex[:12]] if unique else [])
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), "leadflow", *tail])

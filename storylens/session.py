"""Session helpers.

Library code never changes settings of a session it did not create; these
helpers only build sessions for tests, benchmarks and command-line runs, and
locate the shared scratch folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings we want in any session we build ourselves. On a cluster these belong
# in spark-defaults; AQE re-plans partition counts and skewed joins at runtime.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "storylens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where none is set.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach (HDFS, object store); it is used as is. Only a local session without it
    (tests) gets a fresh folder of its own; on a cluster its absence is an error.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="storylens-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder, removed when the application ends."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/storylens/{spark.sparkContext.applicationId}"
    if base not in _scratch:
        folder = spark._jvm.org.apache.hadoop.fs.Path(base)
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
        _scratch.add(base)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_scratch: set[str] = set()


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python file tests can inspect a local path."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)

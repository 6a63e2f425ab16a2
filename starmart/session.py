"""Session helpers.

Library functions never build a session themselves: they take a ``SparkSession`` or a
``DataFrame``.  ``local_session`` is for scripts and tests only.  ``scratch_path`` hands out
unique folders under the shared checkpoint directory the cluster names in
``spark.checkpoint.dir``; a local fallback is created only for a ``local[...]`` master.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session we build gets.  On a cluster these come from the job config.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "starmart",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and scripts (never called by library code)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("STARMART_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # Spark Connect has no SparkContext
        return False


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint dir).  Only a
    local master may fall back to a fresh temporary folder; on a cluster a machine-local folder
    would not be visible to the other executors, so we refuse.
    """
    root = None
    try:
        root = spark.sparkContext.getCheckpointDir()
    except Exception:
        root = None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root:
            try:
                spark.sparkContext.setCheckpointDir(root)
            except Exception:
                pass
    if not root:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for the cluster")
        root = tempfile.mkdtemp(prefix="starmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path (not created) under the shared checkpoint root.

    All such folders of one application lie in one folder, which Hadoop deletes when the
    application's driver ends.
    """
    sc = spark.sparkContext
    root = f"{checkpoint_root(spark)}/starmart-{sc.applicationId}"
    path = sc._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if fs.mkdirs(path):
        fs.deleteOnExit(path)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"

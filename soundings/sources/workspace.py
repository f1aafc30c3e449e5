"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new directory path in the shared folder the session names for checkpoints.

    A local master without such a setting gets a temporary folder. On a cluster that would be
    invisible to executors, so there the setting is required.
    """
    root = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="soundings-")
        spark.conf.set(_CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a directory made by :func:`shared_dir` whose content is no longer read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)

"""The folder for intermediate tables that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the checkpoint folder of the context.

    Where neither is set, a temporary folder serves in local mode; any other master is an error, as each machine has its own
    temporary folders.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="playtrace-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")

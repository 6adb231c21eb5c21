"""Working folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``; where that is unset, a
    local master gets a temporary folder and a cluster a ``ValueError``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="stratakit-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/work-{uuid.uuid4().hex}"

"""A folder for tables that a query writes and reads again."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir; below the machine's temporary folder only in single-machine sessions that name none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), f"inkwell-{spark.sparkContext.applicationId}")
    return f"{root.rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"

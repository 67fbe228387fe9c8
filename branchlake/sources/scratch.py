"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def fresh(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir. Where that is not set, a local session (tests) gets a temporary folder; on a cluster no other machine could read one, so that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-branchlake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/{name}-{uuid.uuid4().hex}"

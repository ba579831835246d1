"""Session settings the library relies on, and the shared folder it may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution does the run-time work: it merges small shuffle partitions, splits skewed join
# partitions and turns a shuffle join into a broadcast join once a side has proved to be small.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster that folder would exist on
    one machine only.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="marlstone-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

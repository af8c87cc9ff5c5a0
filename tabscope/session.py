"""Where shared intermediate tables may be written."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``; without
    that setting, below the warehouse, which is shared as well."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tabscope/{purpose}-{uuid.uuid4().hex}"

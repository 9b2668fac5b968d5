"""Folders for written intermediates and stream checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, or where that is unset under the warehouse: all executors share both."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"

"""Shared folder for intermediate tables that outlive an executor."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below `spark.checkpoint.dir`, which the cluster names.

    Only where that setting is absent and all tasks run in the driver's own process,
    as in tests, a temporary folder takes its place. Elsewhere its absence is an
    error: executors would write to disks of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that executors share")
        root = tempfile.mkdtemp(prefix="logstow-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"

"""The folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder path under the one named by ``spark.checkpoint.dir``.

    Where that is unset, a local session (a test) gets a temporary folder; a
    cluster gets an error, as a machine-local folder would be lost with its
    executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="run-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

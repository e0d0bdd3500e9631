"""A folder for what queries write and read again."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, label: str) -> str:
    """A new folder's path under the session's ``spark.checkpoint.dir``; in local mode without one, a temporary folder of this machine; else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="parcelforge-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"

"""Session helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers.

    Nothing to do where the workers' path already holds the repository; otherwise
    Spark serves a zip of the package to every executor, present and future.
    """
    paths = {os.path.realpath(p or ".") for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if str(_ROOT) in paths or getattr(spark.sparkContext, "_parcelforge_shipped", False):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="parcelforge-"), "parcelforge.zip")
    with zipfile.ZipFile(target, "w") as out:
        for p in sorted((_ROOT / "parcelforge").rglob("*.py")):
            out.write(p, p.relative_to(_ROOT))
    spark.sparkContext.addPyFile(target)
    spark.sparkContext._parcelforge_shipped = True

"""Where Python workers find this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def share_package(spark: SparkSession) -> None:
    """Tell the Python workers of ``spark`` where the driver has the package, for sessions started elsewhere than in its
    folder. On a cluster the package is shipped with the application, and a path that an executor lacks does no harm."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, ROOT]))

"""What a session needs for Python tasks."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def workers_import(spark: SparkSession) -> None:
    """Lets workers of this machine import the package; a cluster gets it as any other (--py-files, or installed)."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))

"""What a session needs for this package's Python workers."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever their working folder is.

    On a cluster the package is installed or shipped by --py-files; a folder that isn't there is passed over.
    """
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in have:
        env["PYTHONPATH"] = ":".join([*have, root])

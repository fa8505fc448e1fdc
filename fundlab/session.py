"""Sessions for local use, and workers that can import this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])


def local_session(cpus: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    conf = {
        "spark.sql.shuffle.partitions": str(partitions), "spark.sql.session.timeZone": "UTC", "spark.driver.memory": memory,
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.adaptive.enabled": "true",
    }
    session = SparkSession.builder.master(f"local[{cpus}]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])

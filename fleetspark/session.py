"""A session with the settings the library's results depend on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: What results depend on (time zone, last-wins maps) and what the plans rely on (adaptive execution).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = 8, memory: str = "8g", partitions: int = 8, name: str = "fleetspark") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own and only need ``SETTINGS``."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.driver.memory", os.environ.get("FLEETSPARK_DRIVER_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )

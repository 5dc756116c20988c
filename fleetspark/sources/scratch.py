"""A folder for intermediate tables that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: The local folder of a session without a shared one, by application.
_LOCAL: dict[str, str] = {}


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, or under a local one where that is unset, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="fleetspark-")
        base = _LOCAL[app]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """A table written once and read again, for plans that need it in several branches."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)

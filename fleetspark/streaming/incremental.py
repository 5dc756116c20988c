"""Incremental loads as a file stream that takes what is new and stops; the checkpoint is the load log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_new(spark: SparkSession, path: str, schema: T.StructType, checkpoint: str, load: Callable[[DataFrame, int], None], files_per_batch: int = 1000) -> None:
    """Give ``load`` the rows of files not seen before, in batches, with each batch's number. A failed batch comes again with its number."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    tagged = stream.select("*", F.col("_metadata.file_path").alias("_file"))
    run = tagged.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()

"""Reading and writing the landing area, quarantine, cursors and versioned tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER = ["_file", "_row"]


def scan(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Landed Parquet under ``dt=`` folders, or some of its files, with ``_file`` and ``_row``, which give its order."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else path)).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def new_files(scanned: DataFrame, log: DataFrame, full_scan: bool = False) -> DataFrame:
    """Rows of files that the load log (``file_path``) doesn't have."""
    return scanned if full_scan else scanned.join(log.select(F.col("file_path").alias("_file")), "_file", "left_anti")


def json_pages(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON pages, each a list or one object: ``raw, _file, _row`` with the place in the page as the row."""
    pages = spark.read.text(path, wholetext=True).select(F.col("value").alias("page"), F.col("_metadata.file_path").alias("_file"))
    v = pages.withColumn("v", F.try_parse_json("page")).where("v IS NOT NULL")
    listed = F.when(F.schema_of_variant("v").startswith("ARRAY"), F.try_variant_get("v", "$", "array<variant>")).otherwise(F.array("v"))
    return v.select("_file", F.posexplode(listed).alias("_row", "r")).select(F.to_json("r").alias("raw"), "_file", "_row")


def write_partitioned(df: DataFrame, path: str, by: str | list[str] = "dt") -> None:
    """Typed Parquet by partition; partitions present in ``df`` are replaced whole, others stay."""
    df.drop(*ORDER).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(by).parquet(path)


def event_day(df: DataFrame, column: str = "creation_date") -> DataFrame:
    """With ``dt``, the first ten characters of an event's time, or ``unknown``."""
    return df.withColumn("dt", F.coalesce(F.nullif(F.left(F.col(column), F.lit(10)), F.lit("")), F.lit("unknown")))


def write_chunk(df: DataFrame, path: str, service: str, chunk: str, column: str = "creation_date") -> None:
    """A chunk of a service's events by their day: ``dt=/service=/chunk=``. A rerun of the chunk replaces its own files of the days it has and no others."""
    rows = event_day(df, column).withColumns({"service": F.lit(service.lower()), "chunk": F.lit(chunk)})
    write_partitioned(rows.hint("rebalance", "dt"), path, ["dt", "service", "chunk"])


def write_quarantine(invalid: DataFrame, path: str, dt: str) -> None:
    """Rejected rows (``error, raw``) as JSON lines of a day."""
    invalid.withColumn("dt", F.lit(dt)).write.mode("append").partitionBy("dt").json(path)


def since(df: DataFrame, column: str, cursor: str | None) -> DataFrame:
    return df if cursor is None else df.where(F.col(column) > cursor)


def read_cursor(spark: SparkSession, path: str, source: str) -> str | None:
    """The cursor of a source, from a state table of one row a source and run; None at first."""
    try:
        state = spark.read.schema("source string, cursor string, run long").parquet(path)
    except Exception as missing:  # no state yet
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise
    return state.where(F.col("source") == source).agg(F.max("cursor")).first()[0]


def advance_cursor(spark: SparkSession, path: str, source: str, cursor: str, run: int) -> None:
    """To be called when the source's write has succeeded, not before."""
    spark.createDataFrame([(source, cursor, run)], "source string, cursor string, run long").write.mode("append").parquet(path)


class Table:
    """A table as a folder of versions; the newest entry of its log names the one to read. Readers of an old version are not disturbed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _log(self) -> list[tuple[int, str]]:
        try:
            rows = self.spark.read.schema("version long, folder string").json(f"{self.path}/log").orderBy("version").collect()  # one row a write
        except Exception as missing:
            if "PATH_NOT_FOUND" in str(missing):
                return []
            raise
        return [(r["version"], r["folder"]) for r in rows]

    def read(self) -> DataFrame | None:
        log = self._log()
        return self.spark.read.parquet(f"{self.path}/{log[-1][1]}") if log else None

    def replace(self, df: DataFrame) -> None:
        """Write a new version whole, then make it the current one."""
        log = self._log()
        version, folder = (log[-1][0] + 1 if log else 0), f"v-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        self.spark.createDataFrame([(version, folder)], "version long, folder string").coalesce(1).write.mode("append").json(f"{self.path}/log")


def active_files(actions: DataFrame, last_commit_only: bool = False) -> DataFrame:
    """Paths in force by a table log of ``version, add, remove``: the last action on a path decides."""
    if last_commit_only:
        last = actions.agg(F.max("version").alias("version"))
        return actions.join(last, "version").where("add IS NOT NULL").select(F.col("add").alias("path"))
    path = F.coalesce("add", "remove").alias("path")
    state = actions.select("version", path, F.col("add").isNotNull().alias("live")).groupBy("path").agg(F.max_by("live", F.struct("version", "live")).alias("live"))
    return state.where("live").select("path")


def csv_report(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A report with a header line, as text columns; a byte-order mark is dropped by the reader."""
    return spark.read.csv(path, header=True, schema=", ".join(f"`{c}` string" for c in columns))


def ndjson_parts(spark: SparkSession, pattern: str) -> DataFrame:
    """Records of the JSON-lines parts that a glob finds, or none: ``raw, _file, _row``, in the order of file and line.

    Lines have no number of their own in a split file, so each part is one record whose lines are numbered; a part is what one page of a
    download left and fits into memory.
    """
    try:
        parts = spark.read.option("ignoreMissingFiles", True).text(pattern, wholetext=True)
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], "raw string, _file string, _row long")
    lines = parts.select(F.col("_metadata.file_path").alias("_file"), F.posexplode(F.split("value", "\r?\n")).alias("_row", "raw"))
    return lines.where(F.trim("raw") != "").select("raw", "_file", F.col("_row").cast("long").alias("_row"))


def write_by_hour(df: DataFrame, path: str, time: str) -> None:
    """Typed Parquet by the day and hour of an event; hours present in ``df`` are replaced whole, others stay."""
    hours = df.withColumns({"dt": F.date_format(time, "yyyy-MM-dd"), "hour": F.date_format(time, "HH")})
    hours.drop(*ORDER).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("dt", "hour").parquet(path)

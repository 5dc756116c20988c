"""What the corpus operators share: shared scratch tables, column checks, small Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Word characters are all but ASCII white space: the pattern every word count here uses.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes of text in an Arrow batch. Texts run to megabytes, so batches are kept short.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20

#: A side joined by broadcast has at most so many bytes, as its rows are counted; beyond it the join shuffles.
BROADCAST_BYTES = 32 << 20
#: What a row of a few numbers takes.
ROW_BYTES = 64


#: The local folder of a session without a shared one, by application.
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or a local one where it is unset and all run on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="fleetspark-")
        found = _LOCAL[app]
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound what a Python worker holds at once; applies to plans executed after the call."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def broadcast_if_small(df: DataFrame, size: Column | int = ROW_BYTES, most: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a stored table for broadcast if its rows, of ``size`` bytes each, sum up to ``most`` at most; otherwise leave the join to shuffle."""
    held = df.agg(F.sum((size if isinstance(size, Column) else F.lit(size)).cast("long"))).first()[0]
    return F.broadcast(df) if (held or 0) <= most else df


def least_hashed(rows: DataFrame, label: str, at: str, most: int) -> DataFrame:
    """Of each label the ``most`` rows of least ``at`` (a hash).

    Labels are counted first, and a row goes on only if its hash is below a bound that leaves about twice as many rows as are
    asked for. So a hot label's rows are filtered where they are read, rows that repeat in all columns become one in map tasks
    already, and the rank sees a bounded number a label.
    """
    counts = rows.groupBy(label).agg(F.count("*").alias("__n"))
    bounds = counts.select(F.col(label).alias("__label"), (F.lit(2.0 * most + 100) / F.col("__n")).alias("__share"))
    unit = F.pmod(F.col(at), F.lit(1 << 24)) / float(1 << 24)
    near = rows.join(F.broadcast(bounds), F.col(label) == F.col("__label")).where(unit < F.col("__share")).select(rows.columns).distinct()  # a row a label
    rank = F.row_number().over(Window.partitionBy(label).orderBy(F.pmod(F.col(at), F.lit(1 << 24)), at, *[c for c in rows.columns if c not in (label, at)]))
    return near.withColumn("__rank", rank).where(F.col("__rank") <= most).drop("__rank")


def within(rows: list, most: int) -> list:
    """Of (group, size, ...) rows in order, those that fit into ``most`` a group; what doesn't fit is passed over."""
    held: dict = {}
    out = []
    for row in rows:
        if held.get(row[0], 0) + row[1] <= most:
            held[row[0]] = held.get(row[0], 0) + row[1]
            out.append(row)
    return out


def whole(text: str | Column = "text") -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

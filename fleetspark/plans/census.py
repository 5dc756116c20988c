"""Profiling of telemetry: which identity fields are filled, which keys bags hold, and what comes in which volume."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filled(tables: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """Per table: rows, and rows in which each column has a value."""
    out = None
    for name, df in tables.items():
        counts = [F.count_if(F.col(c).isNotNull() & (F.col(c).cast("string") != "")).alias(c) if c in df.columns else F.lit(0).cast("long").alias(c) for c in columns]
        row = df.agg(F.count("*").alias("rows"), *counts).withColumn("table_name", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


def bag_keys(df: DataFrame, bag: str, part: str = "") -> DataFrame:
    """How often each key of a JSON bag occurs, of keys that contain ``part``."""
    keys = df.select(F.explode(F.json_object_keys(bag)).alias("key"))
    return keys.where(F.lower("key").contains(part.lower())).groupBy("key").agg(F.count("*").alias("n"))


def volume(df: DataFrame, by: list[str], ts: str) -> DataFrame:
    stamp = lambda f: F.date_format(f(ts), "yyyy-MM-dd HH:mm:ss")
    return df.groupBy(*by).agg(F.count("*").alias("n"), stamp(F.min).alias("first_seen"), stamp(F.max).alias("last_seen"))


def samples(df: DataFrame, condition: str, order: list[str], n: int) -> DataFrame:
    """The first offending rows: the limit is the feature."""
    return df.where(condition).orderBy(*order).limit(n)


def verdict(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column whether identity is there for all, some or no rows."""
    counts = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNotNull() & (F.col(c).cast("string") != "")).alias(c) for c in columns])
    long = counts.unpivot(["rows"], columns, "column_name", "present")
    return long.withColumn("verdict", F.when(F.col("present") == 0, "absent").when(F.col("present") == F.col("rows"), "present").otherwise("partial"))

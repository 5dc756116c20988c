"""Change over days: levels that change, counts that keep rising, deployments that nobody uses, rates that overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.operators.quality import keep_last


def filled(daily: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """``key, day, value`` with a row for each day from a key's first to its last; days without one have 0."""
    spans = daily.groupBy(key).agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
    days = spans.select(key, F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 DAY"))).alias(day))
    return days.join(daily.select(key, day, value), [key, day], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def level_changes(posture: DataFrame, key: str, day: str, level: str, order: str) -> DataFrame:
    """``key, day, before, after, days``: where a key's level differs from that of its last day told, and how many days that was ago.

    Of a day the last row counts; a day without a level says nothing.
    """
    daily = keep_last(posture.where(F.col(level).isNotNull()), [key, day], [order])
    past = Window.partitionBy(key).orderBy(day)
    told = daily.select(key, day, F.lag(level).over(past).alias("before"), F.col(level).alias("after"), F.datediff(day, F.lag(day).over(past)).alias("days"))
    return told.where("before <> after")


def rising_runs(daily: DataFrame, key: str, day: str, value: str, least: int = 3) -> DataFrame:
    """``key, first_day, last_day, steps, gained``: stretches of days on each of which a count exceeds the day's before, of ``least`` steps or more.

    Gaps are days with 0, so a run never leaps over one.
    """
    past = Window.partitionBy(key).orderBy(day)
    stepped = filled(daily, key, day, value).withColumn("_step", F.col(value) - F.lag(value).over(past))
    marked = stepped.withColumn("_run", F.count_if(F.coalesce(F.col("_step") <= 0, F.lit(True))).over(past)).where("_step > 0")
    runs = marked.groupBy(key, "_run").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("steps"), F.sum("_step").alias("gained"))
    return runs.where(F.col("steps") >= least).drop("_run")


def orphan_days(deployed: DataFrame, used: DataFrame, key: str, day: str, days: int = 7) -> DataFrame:
    """``key, day``: days on which a deployment is there and nothing has used it on that day or the ``days`` before.

    A use covers the days behind it, so an equal join takes the place of a join on ranges; both sides are one row a key and day first.
    """
    covered = used.select(key, day).distinct().select(key, F.explode(F.sequence(F.col(day), F.date_add(day, days), F.expr("INTERVAL 1 DAY"))).alias(day)).distinct()
    return deployed.select(key, day).distinct().join(covered, [key, day], "left_anti")


def overlapping_rates(rates: DataFrame, unit: list[str], rate: str = "rate_id") -> DataFrame:
    """``unit, rate, valid_from, valid_to, until``: rates that begin before the latest end among the earlier ones of their unit.

    One look back at a running maximum finds every rate that overlaps an earlier one, also one that lies inside a long one further back.
    An open end is later than any day; an empty or reversed interval is no rate and overlaps nothing.
    """
    end = F.coalesce(F.col("valid_to"), F.lit("9999-12-31").cast("date"))
    kept = rates.withColumn("_end", end).where("valid_from < _end")
    past = Window.partitionBy(*unit).orderBy("valid_from", rate).rowsBetween(Window.unboundedPreceding, -1)
    return kept.withColumn("until", F.max("_end").over(past)).where("valid_from < until").select(*unit, rate, "valid_from", "valid_to", "until")

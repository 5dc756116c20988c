"""Reporting measures as aggregates, the calendar, the cost hierarchy and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.functions import expressions as x


def cost_kpis(cost: DataFrame, allocation: DataFrame) -> DataFrame:
    """Resource, allocated and unallocated cost, tokens, invocations and their ratios; a ratio over 0 is null."""
    spent = cost.agg(F.sum(x.effective_cost()).alias("resource_cost"))
    by = lambda basis: F.sum(F.when(F.col("cost_basis") == basis, F.col("allocated_cost"))).cast("decimal(38,6)")
    parts = allocation.agg(by("allocated").alias("allocated_cost"), by("unallocated").alias("unallocated_cost"), F.sum("tokens").alias("tokens"), F.sum("invocations").alias("invocations"))
    a, t, i = (F.col(c).cast("double") for c in ("allocated_cost", "tokens", "invocations"))
    return spent.crossJoin(parts).select(  # one row each
        "resource_cost", "allocated_cost", "unallocated_cost", "tokens", "invocations", F.round(t / 1e6, 6).alias("tokens_m"),
        F.round(F.try_divide(a, F.col("resource_cost").cast("double")), 6).alias("pct_allocated"), F.round(F.try_divide(a * 1e6, t), 6).alias("cost_per_1m_tokens"), F.round(F.try_divide(a, i), 6).alias("cost_per_invocation"),
    )


def usage_kpis(usage: DataFrame, traces: DataFrame) -> DataFrame:
    """Events, active users (a missing user counts as one), deferred events and trace errors."""
    used = usage.agg(F.sum("events").alias("usage_events"), (F.countDistinct("user_key") + F.max(F.col("user_key").isNull()).cast("int")).alias("active_users"), F.sum("dlp_deferred_events").alias("dlp_deferred"))
    return used.crossJoin(traces.agg(F.sum("error_spans").alias("trace_errors")))  # one row each


def catalogue_kpis(card: DataFrame) -> DataFrame:
    return card.agg(
        F.count("*").alias("agents"), F.count_if("has_usage_signal").alias("with_use"), F.count_if(F.col("tier") == "DECOMMISSION_CANDIDATE").alias("candidates"), F.count_if("in_dup_cluster").alias("in_clusters"),
        F.round(F.try_divide(F.count_if(~F.col("has_usage_signal")).cast("double"), F.count("*").cast("double")), 6).alias("pct_unused"),
    )


def cost_hierarchy(cost: DataFrame) -> DataFrame:
    """Subscription, resource group, category (where there is one) and meter with subtotals."""
    levels = ["subscription_id", "resource_group", *[c for c in ("meter_category",) if c in cost.columns], "meter_name"]
    parts = {"subscription_id": x.resource_part("resource_id", "subscriptions"), "resource_group": x.resource_part("resource_id", "resourcegroups")}
    rows = cost.select(*[parts.get(c, F.col(c)).alias(c) for c in levels], x.effective_cost().alias("c"))
    return rows.rollup(*levels).agg(F.sum("c").alias("cost"), F.grouping_id().cast("long").alias("level"))


def top(df: DataFrame, measure: str, tie: str, n: int) -> DataFrame:
    """The n largest, ties by name: the limit is the feature."""
    return df.orderBy(F.desc(measure), tie).limit(n)


def calendar(days: DataFrame) -> DataFrame:
    """Every day from the first to the last of ``day``, with its parts."""
    span = days.agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a IS NOT NULL")
    return span.select(F.explode(F.sequence("a", "b")).alias("d")).select(
        F.date_format("d", "yyyy-MM-dd").alias("day"), F.year("d").alias("year"), F.month("d").alias("month"), F.dayofweek("d").alias("day_of_week"), F.weekday("d").alias("weekday")
    )


def previous_business_day(days: DataFrame, holidays: list[str], weekdays_only: bool = True) -> DataFrame:
    """``day, previous``: the last business day before each day, from a calendar wide enough to hold one."""
    closed = F.date_format("d", "yyyy-MM-dd").isin(holidays) if holidays else F.lit(False)
    closed = closed | (F.weekday("d") > 4) if weekdays_only else closed
    span = days.agg(F.date_sub(F.min("day"), 30 + len(holidays)).alias("a"), F.max("day").alias("b")).where("b IS NOT NULL")
    all_days = span.select(F.explode(F.sequence("a", "b")).alias("d"))
    before = Window.orderBy("d").rowsBetween(Window.unboundedPreceding, -1)  # a calendar: some thousand rows at most
    known = all_days.withColumn("p", F.max(F.when(~closed, F.col("d"))).over(before))
    return days.select("day").distinct().join(known, F.col("day") == F.col("d")).select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.date_format("p", "yyyy-MM-dd").alias("previous"))


def chunks(ranges: DataFrame, days: int) -> DataFrame:
    """Ranges (``id, start, stop``) cut into runs of ``days`` days; the last is clipped."""
    starts = ranges.select("id", "stop", F.explode(F.sequence("start", "stop", F.expr(f"INTERVAL {days} DAYS"))).alias("chunk_start"))
    return starts.select("id", F.date_format("chunk_start", "yyyy-MM-dd").alias("chunk_start"), F.date_format(F.least(F.date_add("chunk_start", days - 1), "stop"), "yyyy-MM-dd").alias("chunk_stop"))


def cost_anomalies(daily: DataFrame, keys: list[str], window: int = 30) -> DataFrame:
    """Z-score of a day's cost against the days before it; the first ``window`` days are the baseline."""
    before = Window.partitionBy(*keys).orderBy("date_key").rowsBetween(-window, -1)
    seen = F.row_number().over(Window.partitionBy(*keys).orderBy("date_key"))
    cost = F.col("cost").cast("double")
    z = F.try_divide(cost - F.avg(cost).over(before), F.stddev(cost).over(before))
    return daily.withColumn("baseline_period", seen <= window).withColumn("z_score", F.round(z, 4))


def unobserved(agents: DataFrame, audit: DataFrame, as_of: int, days: int = 7) -> DataFrame:
    """Agents of the office cloud without an audit event in the days up to ``as_of``."""
    last = audit.groupBy("agent_key").agg(F.max("date_key").alias("last_day"))
    joined = agents.where("cloud = 'm365' AND agent_key > 0").join(last, "agent_key", "left")
    gap = F.datediff(x.key_date(F.lit(as_of)), x.key_date("last_day"))
    return joined.select("agent_key", "last_day", gap.alias("days_since")).where(F.col("last_day").isNull() | (F.col("days_since") > days))


def billed_variance(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Billed beside estimated cost by key; the two are never added up."""
    by = lines.groupBy(*keys).pivot("cost_source", ["billed", "estimated"]).agg(F.sum("cost"))
    return by.withColumn("variance", F.coalesce("billed", F.lit(0)) - F.coalesce("estimated", F.lit(0)))


def owner_licences(agents: DataFrame, licences: DataFrame) -> DataFrame:
    """Licences at the owner's grain; agents are counted beside them and get no share."""
    owned = agents.where("owner_id IS NOT NULL").groupBy("owner_id").agg(F.count("*").alias("agents"))
    return licences.groupBy("owner_id").agg(F.count("*").alias("licences")).join(owned, "owner_id", "left").withColumn("agents", F.coalesce("agents", F.lit(0)))

"""The reporting views: cost allocation, usage, funnel, scorecard, duplicate clusters, cost methods and unified costing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetspark.functions import expressions as x
from fleetspark.operators.facts import SENTINEL

CENT = "decimal(18,2)"
#: Remainders up to this are rounding; room for the seventh place needs the narrower type on either side.
SMALL = "cast('0.0000005' as decimal(10,7))"


def _daily_cost(cost: DataFrame, keys: list[str]) -> DataFrame:
    return cost.groupBy(*keys).agg(F.sum(x.effective_cost()).alias("cost"), F.max("currency").alias("currency"))


def _shared_out(grain: DataFrame, cost: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Each row's share of its group's cost by tokens, and per group what no row took, if over half a millionth."""
    day_cost = _daily_cost(cost, keys)
    totals = F.sum("tokens").over(Window.partitionBy(*keys))  # the grain is aggregated, a group is some thousand rows
    share = F.col("tokens").cast("double") / F.col("total_tokens") * F.coalesce(F.col("cost").cast("double"), F.lit(0.0))
    allocated = grain.withColumn("total_tokens", totals).join(day_cost, keys, "left").withColumn(
        "allocated_cost", F.when(F.col("total_tokens") > 0, x.millionths(share)).otherwise(F.lit(0).cast("decimal(38,6)"))
    )
    taken = allocated.groupBy(*keys).agg(F.sum("allocated_cost").alias("taken"))
    rest = F.col("cost").cast("decimal(38,6)") - F.coalesce("taken", F.lit(0).cast("decimal(38,6)"))
    left = day_cost.join(taken, keys, "left").withColumn("rest", rest).where(F.col("rest").cast("decimal(30,6)") > F.expr(SMALL))
    return allocated, left


def token_grain(spans: DataFrame) -> DataFrame:
    """Tokens and invocations of attributed spans by the model's cloud, day, agent and model."""
    return (
        spans.where("resolution_tier <> 'unattributed' AND model_key IS NOT NULL")
        .groupBy(x.model_cloud("model_key", "cloud").alias("cloud"), "date_key", "agent_key", "model_key")
        .agg(F.sum(F.coalesce("total_tokens", F.lit(0))).alias("tokens"), F.count_if(F.col("operation_name") == "invoke_agent").alias("invocations"))
    )


def cost_allocation(spans: DataFrame, cost: DataFrame) -> DataFrame:
    """By the model's cloud, day, agent and model: a share of the cloud's cost of the day, and the remainder of each cloud and day."""
    return grain_allocation(token_grain(spans), cost)


def grain_allocation(grain: DataFrame, cost: DataFrame) -> DataFrame:
    """``cost_allocation`` from ``token_grain``, which a caller may have stored: it is read for the shares and for the remainders."""
    allocated, left = _shared_out(grain, cost, ["cloud", "date_key"])
    return allocated.select("cloud", "date_key", "agent_key", "model_key", "tokens", "invocations", "allocated_cost", "currency", F.lit("allocated").alias("cost_basis")).unionByName(
        left.select("cloud", "date_key", F.col("rest").alias("allocated_cost"), "currency", F.lit("unallocated").alias("cost_basis")), allowMissingColumns=True
    )


def agent_cost_daily(spans: DataFrame, cost: DataFrame, agents: DataFrame) -> DataFrame:
    """As above by agent and day over all clouds together, with names and whether the agent may be charged."""
    grain = (
        spans.where("resolution_tier <> 'unattributed'")
        .groupBy("agent_key", "date_key")
        .agg(
            F.sum(F.coalesce("total_tokens", F.lit(0))).alias("tokens"),
            F.count_if(F.col("operation_name") == "invoke_agent").alias("invocations"),
            F.bool_or(F.col("resolution_tier").isin("native", "bridge")).alias("chargeback_eligible"),
        )
        .join(agents.select("agent_key", "agent_name"), "agent_key")
    )
    allocated, left = _shared_out(grain, cost, ["date_key"])
    columns = ["agent_key", "agent_name", "date_key", "tokens", "invocations", "chargeback_eligible", "total_tokens", F.col("cost").alias("day_resource_cost"), "currency", "allocated_cost"]
    rest = left.select(
        F.lit("(unallocated)").alias("agent_name"), "date_key", F.lit(False).alias("chargeback_eligible"), F.col("cost").alias("day_resource_cost"), "currency",
        F.col("rest").alias("allocated_cost"), F.lit("unallocated").alias("cost_basis"),
    )
    return allocated.select(*columns, F.lit("allocated").alias("cost_basis")).unionByName(rest, allowMissingColumns=True)


def unregistered(spans: DataFrame) -> DataFrame:
    """Unattributed spans by the head of their id and what is known of it."""
    stamp = lambda f: F.date_format(f("ts"), "yyyy-MM-dd HH:mm:ss")
    return (
        spans.where("resolution_tier = 'unattributed'")
        .groupBy(x.id_head("native_agent_id").alias("unresolved_agent_id"), x.signal_class("native_agent_id").alias("signal_class"))
        .agg(
            F.count("*").alias("spans"),
            F.countDistinct("trace_id").alias("traces"),
            F.sum(F.coalesce("total_tokens", F.lit(0))).alias("tokens"),
            stamp(F.min).alias("first_seen"),
            stamp(F.max).alias("last_seen"),
        )
        .orderBy(F.desc("tokens"), "unresolved_agent_id")
    )


def usage_daily(audit: DataFrame) -> DataFrame:
    return audit.groupBy("date_key", "agent_key", "user_key", "record_type", "resolution_tier").agg(
        F.count("*").alias("events"),
        F.count_if(F.col("error_type").isNotNull() & (F.col("error_type") != "")).alias("error_events"),
        F.count_if(F.col("dlp_evaluation_deferred") == 1).alias("dlp_deferred_events"),
    )


def traces_daily(spans: DataFrame) -> DataFrame:
    none = F.lit(0)
    return spans.groupBy("date_key", "agent_key", "model_key", "resolution_tier").agg(
        F.count("*").alias("spans"),
        F.count_if(F.col("operation_name") == "invoke_agent").alias("invocations"),
        F.count_if(x.is_http_error("status")).alias("error_spans"),
        F.sum(F.coalesce("input_tokens", none)).alias("input_tokens"),
        F.sum(F.coalesce("output_tokens", none)).alias("output_tokens"),
        F.sum(F.coalesce("total_tokens", none)).alias("total_tokens"),
        F.round(F.avg("duration_ms"), 2).cast("double").alias("avg_duration_ms"),
    )


def funnel_daily(audit: DataFrame, spans: DataFrame, agents: DataFrame, cost: DataFrame) -> DataFrame:
    """Usage, traces by the agent's cloud, and cost side by side."""
    keys = ["date_key", "cloud"]
    used = audit.groupBy("date_key").agg(F.count("*").alias("audit_events"), F.countDistinct("user_key").alias("audit_users")).withColumn("cloud", F.lit("m365"))
    by_agent = spans.groupBy("date_key", "agent_key").agg(F.count_if(F.col("operation_name") == "invoke_agent").alias("i"), F.sum(F.coalesce("total_tokens", F.lit(0))).alias("t"))
    traced = by_agent.join(agents.select("agent_key", "cloud"), "agent_key").groupBy(*keys).agg(F.sum("i").alias("invocations"), F.sum("t").alias("tokens"))
    spent = _daily_cost(cost, keys).withColumnRenamed("cost", "resource_cost")
    return used.join(traced, keys, "full").join(spent, keys, "full").select(*keys, "audit_events", "audit_users", "invocations", "tokens", "resource_cost", "currency")


def scorecard(agents: DataFrame, audit: DataFrame, spans: DataFrame, allocation: DataFrame) -> DataFrame:
    """Each agent with its duplicate cluster, usage, cost and tier. Facts are reduced to one row an agent before they join."""
    real = agents.where(F.col("native_agent_id") != SENTINEL)
    clusters = real.where("config_hash IS NOT NULL AND config_hash <> ''").groupBy("config_hash").agg(F.count("*").alias("cluster_size")).where("cluster_size > 1")
    used = audit.where("resolution_tier = 'native'").groupBy("agent_key").agg(F.count("*").alias("audit_events"), F.countDistinct("user_key").alias("distinct_users"), F.max("date_key").alias("last_audit_day"))
    traced = spans.where("resolution_tier IN ('native', 'bridge')").groupBy("agent_key").agg(
        F.count_if(F.col("operation_name") == "invoke_agent").alias("invocations"), F.sum(F.coalesce("total_tokens", F.lit(0))).alias("total_tokens"), F.max("date_key").alias("last_trace_day")
    )
    cost = allocation.where("cost_basis = 'allocated'").groupBy("agent_key").agg(F.sum("allocated_cost").alias("allocated_cost_eur"))
    joined = real.join(clusters, "config_hash", "left").join(used, "agent_key", "left").join(traced, "agent_key", "left").join(cost, "agent_key", "left")
    signal = F.col("audit_events").isNotNull() | F.col("invocations").isNotNull()
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return joined.select(
        "agent_key", "cloud", "native_agent_id", "agent_name", "agent_type", "owner_id", "config_hash",
        F.coalesce("cluster_size", F.lit(1)).alias("cluster_size"), F.col("cluster_size").isNotNull().alias("in_dup_cluster"),
        zero("audit_events"), zero("distinct_users"), "last_audit_day", zero("invocations"), zero("total_tokens"), "last_trace_day",
        F.coalesce("allocated_cost_eur", F.lit(0).cast("decimal(38,6)")).alias("allocated_cost_eur"), signal.alias("has_usage_signal"),
        (F.coalesce("distinct_users", F.lit(0)) == 1).alias("single_user"),
        F.when(signal, "KEEP").when(F.col("cluster_size").isNotNull(), "DECOMMISSION_CANDIDATE").otherwise("REVIEW").alias("tier"),
    )


def dup_clusters(card: DataFrame, agents: DataFrame) -> DataFrame:
    """Clusters of agents with one configuration."""
    members = card.where("in_dup_cluster").join(agents.select("agent_key", "instructions"), "agent_key")
    return members.groupBy("config_hash").agg(
        F.count("*").alias("members"),
        F.nullif(F.array_join(F.array_sort(F.collect_set("agent_type")), ", "), F.lit("")).alias("agent_types"),
        F.min("agent_name").alias("sample_name"),
        F.count_if("has_usage_signal").alias("used_members"),
        F.sum("audit_events").alias("total_audit_events"),
        F.sum("total_tokens").alias("total_tokens"),
        F.sum("allocated_cost_eur").alias("allocated_cost_eur"),
        F.left(F.max("instructions"), F.lit(300)).alias("prompt_sample"),
    )


# Cost method by cloud and type pattern: (cloud, pattern, method, driver, priority).
METHODS = [
    ("aws", "%", "metered_allocated", "tokens", 100),
    ("aws", "__NULL__", "metered_allocated", "tokens", 50),
    ("azure", "%", "metered_allocated", "tokens", 100),
    ("azure", "__NULL__", "metered_allocated", "tokens", 50),
    ("m365", "SharePoint", "bundled_zero", "none", 50),
    ("m365", "Microsoft 365 Agents Toolkit", "bundled_zero", "none", 50),
    ("m365", "Not Available", "bundled_zero", "none", 50),
    ("m365", "%Teams%", "bundled_zero", "none", 50),
    ("m365", "Copilot Studio", "credit_rated", "audit_events", 50),
    ("m365", "Microsoft 365 Copilot Agent Builder", "credit_rated", "audit_events", 50),
    ("m365", "%Declarative%", "credit_rated", "audit_events", 50),
    ("m365", "__NULL__", "credit_rated", "audit_events", 50),
    ("m365", "Foundry", "metered_allocated", "tokens", 50),
    ("m365", "Databricks", "metered_allocated", "tokens", 50),
    ("m365", "%Bedrock%", "metered_allocated", "tokens", 50),
    ("m365", "%", "credit_rated", "audit_events", 200),
]
# Rates: (scope, driver, unit rate, valid from, valid to).
RATES = [
    ("m365", "credit", "0.008684", "2026-01-01", None),
    ("m365", "credit_pack", "0.006947", "2026-01-01", None),
    ("m365", "copilot_seat_month", "26.05", "2026-01-01", None),
    ("fx", "usd_eur", "0.868405", "2026-01-01", None),
]


def method_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i + 1, *m) for i, m in enumerate(METHODS)], "map_id int, cloud string, agent_type_pattern string, cost_method string, cost_driver string, priority int")


def rates(spark: SparkSession, since: str | None = None) -> DataFrame:
    """The rates; ``since`` moves their start, for data that is older."""
    return spark.createDataFrame(RATES, "scope string, driver string, unit_rate string, valid_from string, valid_to string").select(
        "scope", "driver", F.col("unit_rate").cast("decimal(18,6)").alias("unit_rate"), F.to_date(F.coalesce(F.lit(since), F.col("valid_from"))).alias("valid_from"), F.to_date("valid_to").alias("valid_to")
    )


def cost_methods(agents: DataFrame, methods: DataFrame) -> DataFrame:
    """Per agent the first pattern that fits, by priority, then number. The few patterns are broadcast; their cloud is an equal join."""
    m = F.broadcast(methods.withColumnRenamed("cloud", "m_cloud"))  # a curated table, METHODS has its size
    fits = (F.col("cloud") == F.col("m_cloud")) & F.when(F.col("agent_type").isNull(), F.col("agent_type_pattern") == "__NULL__").otherwise(F.expr("agent_type LIKE agent_type_pattern"))
    best = agents.join(m, fits).groupBy("agent_key", "cloud", "agent_type").agg(F.min_by(F.struct("cost_method", "cost_driver"), F.struct("priority", "map_id")).alias("b"))
    return best.select("agent_key", "cloud", "agent_type", "b.cost_method", "b.cost_driver")


def _rate_on(rates_: DataFrame, scope: str, driver: str, alias: str) -> DataFrame:
    return rates_.where((F.col("scope") == scope) & (F.col("driver") == driver)).select("valid_from", "valid_to", F.col("unit_rate").alias(alias))


def _valid(day: str):
    return (F.col("valid_from") <= F.col(day)) & (F.col("valid_to").isNull() | (F.col(day) < F.col("valid_to")))


def weekly_pools(credits: DataFrame) -> DataFrame:
    """``date_key, week_start, paid, included, seats``: credits of unlicensed and of licensed people, and the licensed people, by week."""
    licensed = F.coalesce("is_copilot_licensed", F.lit(False))
    return credits.groupBy("date_key", "week_start").agg(
        F.coalesce(F.sum(F.when(~licensed, F.col("total_credits_used"))), F.lit(0)).cast("decimal(38,6)").alias("paid"),
        F.coalesce(F.sum(F.when(licensed, F.col("total_credits_used"))), F.lit(0)).cast("decimal(38,6)").alias("included"),
        F.countDistinct(F.when(licensed, F.col("person_id"))).alias("seats"),
    )


def events_daily(audit: DataFrame) -> DataFrame:
    """``date_key, agent_key, n``: audit events of known agents by day."""
    return audit.where("agent_key IS NOT NULL").groupBy("date_key", "agent_key").agg(F.count("*").alias("n"))


def unified_cost(allocation: DataFrame, pools: DataFrame, daily: DataFrame, agents: DataFrame, methods: DataFrame, rates_: DataFrame) -> DataFrame:
    """Metered cost by day, weekly credit pools shared out by events, and seats, in one table told apart by ``period_grain``.

    ``pools`` is ``weekly_pools``, ``daily`` is ``events_daily``; four branches read them, so a caller stores them.
    Weeks meet events by the seven days of each week, an equal join instead of an interval; rates, a curated table of a few rows, are broadcast.
    """
    qty = "decimal(38,6)"
    metered = allocation.groupBy("date_key", "cloud", "agent_key", "cost_basis").agg(F.sum("tokens").cast(qty).alias("driver_qty"), F.sum("allocated_cost").cast(qty).alias("allocated_cost"), F.max("currency").alias("currency")).select(
        "date_key", "cloud", "agent_key", F.lit("metered_allocated").alias("cost_method"), F.lit("tokens").alias("cost_driver"), "driver_qty", F.lit(None).cast("decimal(18,6)").alias("unit_rate"),
        "allocated_cost", "currency", F.when(F.col("cost_basis") == "allocated", "billed_allocated").otherwise("billed_unallocated").alias("cost_quality"), F.lit("day").alias("period_grain"),
    )

    weeks = pools.join(F.broadcast(_rate_on(rates_, "m365", "credit", "rate")), _valid("week_start")).select("date_key", "week_start", "paid", "included", "rate")

    days = weeks.select(F.col("date_key").alias("week"), F.explode(F.sequence("week_start", F.date_add("week_start", 6))).alias("day"))
    per_day = daily.select(x.key_date("date_key").alias("day"), "agent_key", "n")
    events = days.join(per_day, "day").groupBy("week", "agent_key").agg(F.sum("n").alias("agent_events"))
    totals = events.groupBy("week").agg(F.sum("agent_events").alias("all_events"))
    eligible = methods.where("cost_method = 'credit_rated'").select("agent_key").join(agents.where(F.col("native_agent_id") == SENTINEL).select("agent_key"), "agent_key", "left_anti")
    cost = x.millionths((F.col("paid").cast("double") * F.col("rate").cast("double") * F.col("agent_events")) / F.col("all_events"))
    shares = events.join(eligible, "agent_key").join(totals, "week").join(weeks, F.col("week") == F.col("date_key")).withColumn("agent_cost", cost)
    assigned = shares.groupBy("week").agg(F.sum("agent_cost").alias("assigned"))

    def rows(df: DataFrame, agent, driver: str, quantity, rate, amount, quality: str, method: str = "credit_rated") -> DataFrame:
        return df.select(
            "date_key", F.lit("m365").alias("cloud"), agent.cast("bigint").alias("agent_key"), F.lit(method).alias("cost_method"), F.lit(driver).alias("cost_driver"), quantity.cast(qty).alias("driver_qty"),
            rate.cast("decimal(18,6)").alias("unit_rate"), amount.cast(qty).alias("allocated_cost"), F.lit("EUR").alias("currency"), F.lit(quality).alias("cost_quality"), F.lit("week").alias("period_grain"),
        )

    none, rate = F.lit(None), F.col("rate")
    summary = weeks.join(assigned, F.col("week") == F.col("date_key"), "left").withColumn("assigned", F.coalesce("assigned", F.lit(0).cast(qty)))
    paid = x.millionths(F.col("paid").cast("double") * rate.cast("double") - F.col("assigned").cast("double"))
    unused = x.millionths(F.col("paid").cast("double") - F.try_divide(F.col("assigned").cast("double"), rate.cast("double")))
    seat = pools.join(F.broadcast(_rate_on(rates_, "m365", "copilot_seat_month", "rate")), _valid("week_start"))
    return (
        metered.unionByName(rows(shares, F.col("agent_key"), "audit_events", F.col("agent_events"), rate, F.col("agent_cost"), "rated_payg_allocated"))
        .unionByName(rows(summary, none, "audit_events", unused, rate, paid, "rated_payg_unallocated"))
        .unionByName(rows(weeks, none, "credits", F.col("included"), rate, x.millionths(F.col("included").cast("double") * rate.cast("double")), "rated_included"))
        .unionByName(rows(seat, none, "seats", F.col("seats"), rate, x.millionths(F.col("seats") * rate.cast("double") * 12.0 / 52.18), "estimated", "license_amortized"))
    )


def additive_total(unified: DataFrame) -> DataFrame:
    """What may be summed (billed, paid and estimated), and the memo of what licences include."""
    adds = F.col("cost_quality").startswith("billed_") | F.col("cost_quality").startswith("rated_payg") | (F.col("cost_quality") == "estimated")
    return unified.agg(F.sum(F.when(adds, F.col("allocated_cost"))).cast("decimal(38,6)").alias("additive_total"), F.sum(F.when(F.col("cost_quality") == "rated_included", F.col("allocated_cost"))).cast("decimal(38,6)").alias("memo_total"))

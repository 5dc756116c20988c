"""The registered queries: each operator over the bound views, with an independent SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.functions import expressions as x
from fleetspark.operators import facts, flatten, quality
from fleetspark.plans import measures, views
from fleetspark.plans.bind import bound, with_views
from fleetspark.plans.registry import query
from fleetspark.sources.scratch import stored

SINCE = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spans_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.resolve(bound(spark, sf_dir, "b_span"), bound(spark, sf_dir, "b_agent"), bound(spark, sf_dir, "b_identity"))


def audit_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.audit_keys(bound(spark, sf_dir, "b_audit"), bound(spark, sf_dir, "b_agent"))


def allocation_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.cost_allocation(spans_of(spark, sf_dir), bound(spark, sf_dir, "b_cost"))


def unified_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unified cost. What several of its branches read is stored first, reduced: tokens by agent, model and day, events by agent and day, pools by week."""
    agents = bound(spark, sf_dir, "b_agent")
    methods = views.cost_methods(agents, views.method_map(spark))
    grain = stored(views.token_grain(spans_of(spark, sf_dir)), "grain")
    daily = stored(views.events_daily(audit_of(spark, sf_dir)), "events")
    pools = stored(views.weekly_pools(bound(spark, sf_dir, "b_credits")), "pools")
    return views.unified_cost(views.grain_allocation(grain, bound(spark, sf_dir, "b_cost")), pools, daily, agents, methods, views.rates(spark, SINCE))


def scorecard_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorecard; spans are resolved once, for their use and for what they are allocated."""
    spans = stored(spans_of(spark, sf_dir), "spans")
    return views.scorecard(bound(spark, sf_dir, "b_agent"), audit_of(spark, sf_dir), spans, views.cost_allocation(spans, bound(spark, sf_dir, "b_cost")))


# --- pieces of the SQL twins -------------------------------------------------------------------------------------

SPAN_VIEWS = ["b_agent", "b_identity", "b_span"]
SPANS = """,
bridge AS (SELECT native_id, min(agent_key) AS k FROM b_identity WHERE valid_to IS NULL GROUP BY 1),
native AS (SELECT native_agent_id, min(agent_key) AS k FROM b_agent WHERE native_agent_id <> '(unattributed)' GROUP BY 1),
per_trace AS (SELECT trace_id, regexp_replace(arg_min(native_agent_id, span_id), ':[^:]*$', '') AS base FROM b_span WHERE native_agent_id IS NOT NULL GROUP BY 1),
trace_keys AS (SELECT trace_id, coalesce(b.k, n.k) AS trace_key FROM per_trace p LEFT JOIN bridge b ON b.native_id = p.base LEFT JOIN native n ON n.native_agent_id = p.base),
r_span AS (
  SELECT s.*, coalesce(b.k, n.k, t.trace_key, z.agent_key) AS agent_key,
         CASE WHEN b.k IS NOT NULL THEN 'bridge' WHEN n.k IS NOT NULL THEN 'native' WHEN t.trace_key IS NOT NULL THEN 'correlation' ELSE 'unattributed' END AS resolution_tier
  FROM b_span s
  LEFT JOIN bridge b ON b.native_id = regexp_replace(s.native_agent_id, ':[^:]*$', '')
  LEFT JOIN native n ON n.native_agent_id = regexp_replace(s.native_agent_id, ':[^:]*$', '')
  LEFT JOIN trace_keys t ON t.trace_id = s.trace_id
  LEFT JOIN (SELECT cloud, agent_key FROM b_agent WHERE native_agent_id = '(unattributed)') z ON z.cloud = s.cloud)
"""
AUDIT = """,
r_audit AS (
  SELECT e.*, coalesce(k.agent_key, CAST(-3 AS BIGINT)) AS agent_key, CASE WHEN k.agent_key IS NULL THEN 'unattributed' ELSE 'native' END AS resolution_tier
  FROM b_audit e LEFT JOIN (SELECT native_agent_id AS kid, agent_key FROM b_agent WHERE cloud = 'm365' AND native_agent_id <> '(unattributed)') k ON k.kid = e.native_agent_id)
"""
ALLOCATION = """,
grain AS (
  SELECT CASE WHEN model_key LIKE 'amazon.%' THEN 'aws' ELSE cloud END AS cloud, date_key, agent_key, model_key,
         CAST(sum(coalesce(total_tokens, 0)) AS BIGINT) AS tokens, count(*) FILTER (WHERE operation_name = 'invoke_agent') AS invocations
  FROM r_span WHERE resolution_tier <> 'unattributed' GROUP BY 1, 2, 3, 4),
cloud_tokens AS (SELECT cloud, date_key, sum(tokens) AS total FROM grain GROUP BY 1, 2),
cloud_cost AS (SELECT cloud, date_key, sum(CAST(coalesce(effective_cost, billed_cost, 0) AS DECIMAL(18, 2))) AS cost, max(currency) AS currency FROM b_cost GROUP BY 1, 2),
shares AS (
  SELECT g.*, CAST(CASE WHEN t.total > 0 THEN round(CAST(g.tokens AS DOUBLE) / t.total * coalesce(CAST(c.cost AS DOUBLE), 0), 6) ELSE 0 END AS DECIMAL(38, 6)) AS allocated_cost, c.currency
  FROM grain g JOIN cloud_tokens t USING (cloud, date_key) LEFT JOIN cloud_cost c USING (cloud, date_key)),
allocation AS (
  SELECT cloud, date_key, agent_key, model_key, tokens, invocations, allocated_cost, currency, 'allocated' AS cost_basis FROM shares
  UNION ALL
  SELECT c.cloud, c.date_key, NULL, NULL, NULL, NULL, CAST(c.cost - coalesce(s.taken, 0) AS DECIMAL(38, 6)), c.currency, 'unallocated'
  FROM cloud_cost c LEFT JOIN (SELECT cloud, date_key, sum(allocated_cost) AS taken FROM shares GROUP BY 1, 2) s USING (cloud, date_key)
  WHERE c.cost - coalesce(s.taken, 0) > 0.0000005)
"""
CARD = """,
cluster AS (SELECT config_hash, count(*) AS cluster_size FROM b_agent WHERE config_hash <> '' AND native_agent_id <> '(unattributed)' GROUP BY 1 HAVING count(*) > 1),
used AS (SELECT agent_key, count(*) AS audit_events, count(DISTINCT user_key) AS distinct_users, max(date_key) AS last_audit_day FROM r_audit WHERE resolution_tier = 'native' GROUP BY 1),
traced AS (SELECT agent_key, count(*) FILTER (WHERE operation_name = 'invoke_agent') AS invocations, CAST(sum(coalesce(total_tokens, 0)) AS BIGINT) AS total_tokens, max(date_key) AS last_trace_day
           FROM r_span WHERE resolution_tier IN ('native', 'bridge') GROUP BY 1),
spent AS (SELECT agent_key, CAST(sum(allocated_cost) AS DECIMAL(38, 6)) AS allocated_cost FROM allocation WHERE cost_basis = 'allocated' GROUP BY 1),
card AS (
  SELECT a.agent_key, a.cloud, a.native_agent_id, a.agent_name, a.agent_type, a.owner_id, a.config_hash, coalesce(c.cluster_size, 1) AS cluster_size, c.cluster_size IS NOT NULL AS in_dup_cluster,
         coalesce(u.audit_events, 0) AS audit_events, coalesce(u.distinct_users, 0) AS distinct_users, u.last_audit_day, coalesce(t.invocations, 0) AS invocations,
         coalesce(t.total_tokens, 0) AS total_tokens, t.last_trace_day, coalesce(s.allocated_cost, 0) AS allocated_cost_eur,
         u.agent_key IS NOT NULL OR t.agent_key IS NOT NULL AS has_usage_signal, coalesce(u.distinct_users, 0) = 1 AS single_user,
         CASE WHEN u.agent_key IS NOT NULL OR t.agent_key IS NOT NULL THEN 'KEEP' WHEN c.cluster_size IS NOT NULL THEN 'DECOMMISSION_CANDIDATE' ELSE 'REVIEW' END AS tier
  FROM b_agent a LEFT JOIN cluster c ON c.config_hash = a.config_hash LEFT JOIN used u ON u.agent_key = a.agent_key
  LEFT JOIN traced t ON t.agent_key = a.agent_key LEFT JOIN spent s ON s.agent_key = a.agent_key
  WHERE a.native_agent_id <> '(unattributed)')
"""


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("NULL" if v is None else str(v) if isinstance(v, int) else f"'{v}'" for v in r) + ")" for r in rows)


METHOD = f""",
patterns(map_id, cloud, pattern, cost_method, cost_driver, priority) AS (VALUES {_values([(i + 1, *m) for i, m in enumerate(views.METHODS)])}),
method AS (
  SELECT agent_key, cloud, agent_type, cost_method, cost_driver FROM (
    SELECT a.agent_key, a.cloud, a.agent_type, p.cost_method, p.cost_driver, row_number() OVER (PARTITION BY a.agent_key ORDER BY p.priority, p.map_id) AS r
    FROM b_agent a JOIN patterns p ON p.cloud = a.cloud AND (a.agent_type LIKE p.pattern OR (a.agent_type IS NULL AND p.pattern = '__NULL__'))) WHERE r = 1)
"""
Q = "CAST({} AS DECIMAL(38, 6))"
UNIFIED = f""",
pool AS (
  SELECT date_key, week_start, coalesce(sum(total_credits_used) FILTER (WHERE NOT coalesce(is_copilot_licensed, false)), 0) AS paid,
         coalesce(sum(total_credits_used) FILTER (WHERE is_copilot_licensed), 0) AS included, count(DISTINCT person_id) FILTER (WHERE is_copilot_licensed) AS seats
  FROM b_credits GROUP BY 1, 2),
dated AS (SELECT strptime(CAST(date_key AS VARCHAR), '%Y%m%d')::DATE AS day, agent_key FROM r_audit),
per_week AS (SELECT p.date_key, e.agent_key, count(*) AS n FROM pool p JOIN dated e ON e.day BETWEEN p.week_start AND p.week_start + 6 GROUP BY 1, 2),
per_all AS (SELECT date_key, sum(n) AS total FROM per_week GROUP BY 1),
agent_share AS (
  SELECT w.date_key, w.agent_key, w.n, {Q.format("round(CAST(p.paid AS DOUBLE) * 0.008684 * w.n / t.total, 6)")} AS cost
  FROM per_week w JOIN pool p USING (date_key) JOIN per_all t USING (date_key) JOIN method m ON m.agent_key = w.agent_key AND m.cost_method = 'credit_rated' WHERE w.agent_key > 0),
week_sum AS (SELECT p.date_key, p.paid, p.included, coalesce(sum(s.cost), 0) AS assigned FROM pool p LEFT JOIN agent_share s USING (date_key) GROUP BY 1, 2, 3),
unified AS (
  SELECT date_key, cloud, agent_key, 'metered_allocated' AS cost_method, 'tokens' AS cost_driver, {Q.format("sum(tokens)")} AS driver_qty, CAST(NULL AS DECIMAL(18, 6)) AS unit_rate,
         {Q.format("sum(allocated_cost)")} AS allocated_cost, max(currency) AS currency, CASE WHEN cost_basis = 'allocated' THEN 'billed_allocated' ELSE 'billed_unallocated' END AS cost_quality, 'day' AS period_grain
  FROM allocation GROUP BY date_key, cloud, agent_key, cost_basis
  UNION ALL SELECT date_key, 'm365', agent_key, 'credit_rated', 'audit_events', {Q.format("n")}, CAST(0.008684 AS DECIMAL(18, 6)), cost, 'EUR', 'rated_payg_allocated', 'week' FROM agent_share
  UNION ALL SELECT date_key, 'm365', NULL, 'credit_rated', 'audit_events', {Q.format("round(CAST(paid AS DOUBLE) - CAST(assigned AS DOUBLE) / 0.008684, 6)")}, CAST(0.008684 AS DECIMAL(18, 6)),
         {Q.format("round(CAST(paid AS DOUBLE) * 0.008684 - CAST(assigned AS DOUBLE), 6)")}, 'EUR', 'rated_payg_unallocated', 'week' FROM week_sum
  UNION ALL SELECT date_key, 'm365', NULL, 'credit_rated', 'credits', {Q.format("included")}, CAST(0.008684 AS DECIMAL(18, 6)), {Q.format("round(CAST(included AS DOUBLE) * 0.008684, 6)")}, 'EUR', 'rated_included', 'week' FROM pool
  UNION ALL SELECT date_key, 'm365', NULL, 'license_amortized', 'seats', {Q.format("seats")}, CAST(26.05 AS DECIMAL(18, 6)), {Q.format("round(seats * CAST(26.05 AS DOUBLE) * 12.0 / 52.18, 6)")}, 'EUR', 'estimated', 'week' FROM pool)
"""


def _sql(names: list[str], *parts: str) -> str:
    return with_views(names, "".join(parts))


# --- resolution, allocation and the daily views ------------------------------------------------------------------


@query("cost_allocation", _sql([*SPAN_VIEWS, "b_cost"], SPANS, ALLOCATION, "SELECT * FROM allocation"))
def cost_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocation_of(spark, sf_dir)


@query(
    "agent_cost_daily",
    _sql(
        [*SPAN_VIEWS, "b_cost"],
        SPANS,
        """,
agent_day AS (
  SELECT agent_key, date_key, CAST(sum(coalesce(total_tokens, 0)) AS BIGINT) AS tokens, count(*) FILTER (WHERE operation_name = 'invoke_agent') AS invocations,
         bool_or(resolution_tier IN ('native', 'bridge')) AS chargeback_eligible FROM r_span WHERE resolution_tier <> 'unattributed' GROUP BY 1, 2),
totals AS (SELECT date_key, CAST(sum(tokens) AS BIGINT) AS total_tokens FROM agent_day GROUP BY 1),
costs AS (SELECT date_key, sum(CAST(coalesce(effective_cost, billed_cost, 0) AS DECIMAL(18, 2))) AS cost, max(currency) AS currency FROM b_cost GROUP BY 1),
taken AS (
  SELECT d.agent_key, a.agent_name, d.date_key, d.tokens, d.invocations, d.chargeback_eligible, t.total_tokens, c.cost AS day_resource_cost, c.currency,
         CAST(CASE WHEN t.total_tokens > 0 THEN round(CAST(d.tokens AS DOUBLE) / t.total_tokens * coalesce(CAST(c.cost AS DOUBLE), 0), 6) ELSE 0 END AS DECIMAL(38, 6)) AS allocated_cost, 'allocated' AS cost_basis
  FROM agent_day d JOIN b_agent a USING (agent_key) JOIN totals t USING (date_key) LEFT JOIN costs c USING (date_key))
SELECT * FROM taken UNION ALL
SELECT NULL, '(unallocated)', date_key, NULL, NULL, false, NULL, cost, currency, CAST(cost - coalesce(s, 0) AS DECIMAL(38, 6)), 'unallocated'
FROM costs LEFT JOIN (SELECT date_key, sum(allocated_cost) AS s FROM taken GROUP BY 1) USING (date_key) WHERE cost - coalesce(s, 0) > 0.0000005""",
    ),
)
def agent_cost_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.agent_cost_daily(spans_of(spark, sf_dir), bound(spark, sf_dir, "b_cost"), bound(spark, sf_dir, "b_agent"))


@query("resolution_tiers", _sql(SPAN_VIEWS, SPANS, "SELECT resolution_tier, count(*) AS spans, count(DISTINCT agent_key) AS agents FROM r_span GROUP BY 1"))
def resolution_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans_of(spark, sf_dir).groupBy("resolution_tier").agg(F.count("*").alias("spans"), F.countDistinct("agent_key").alias("agents"))


@query(
    "span_facts",
    _sql(
        SPAN_VIEWS,
        SPANS,
        """SELECT trace_id, span_id, agent_key, resolution_tier, date_key, model_key, status, NULLIF(total_tokens, 0) AS total_tokens,
        CASE operation_name WHEN 'invoke_agent' THEN 'agent_run' WHEN 'chat' THEN 'model_call' WHEN 'execute_tool' THEN 'tool_call' ELSE operation_name END AS span_kind FROM r_span""",
    ),
)
def span_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The span fact: a total of 0 tokens is stored as null, consumption keeps it."""
    return spans_of(spark, sf_dir).select(
        "trace_id", "span_id", "agent_key", "resolution_tier", "date_key", "model_key", "status", F.nullif(F.col("total_tokens"), F.lit(0)).alias("total_tokens"), x.span_kind("operation_name").alias("span_kind")
    )


@query(
    "unregistered_consumption",
    _sql(
        SPAN_VIEWS,
        SPANS,
        """SELECT split_part(coalesce(native_agent_id, ''), ':', 1) AS unresolved_agent_id,
        CASE WHEN coalesce(native_agent_id, '') = '' THEN 'no_agent_id' WHEN regexp_matches(native_agent_id, '^[0-9a-f]{8}-[0-9a-f]{4}-') THEN 'guid_only' ELSE 'named_unregistered' END AS signal_class,
        count(*) AS spans, count(DISTINCT trace_id) AS traces, CAST(sum(coalesce(total_tokens, 0)) AS BIGINT) AS tokens,
        strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen
        FROM r_span WHERE resolution_tier = 'unattributed' GROUP BY 1, 2""",
    ),
)
def unregistered_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.unregistered(spans_of(spark, sf_dir))


@query(
    "usage_daily",
    _sql(
        ["b_agent", "b_audit"],
        AUDIT,
        """SELECT date_key, agent_key, user_key, record_type, resolution_tier, count(*) AS events,
        count(*) FILTER (WHERE error_type <> '') AS error_events, count(*) FILTER (WHERE dlp_evaluation_deferred = 1) AS dlp_deferred_events FROM r_audit GROUP BY ALL""",
    ),
)
def usage_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.usage_daily(audit_of(spark, sf_dir))


@query(
    "traces_daily",
    _sql(
        SPAN_VIEWS,
        SPANS,
        """SELECT date_key, agent_key, model_key, resolution_tier, count(*) AS spans, count(*) FILTER (WHERE operation_name = 'invoke_agent') AS invocations,
        count(*) FILTER (WHERE status SIMILAR TO '[45].*') AS error_spans, CAST(sum(coalesce(input_tokens, 0)) AS BIGINT) AS input_tokens,
        CAST(sum(coalesce(output_tokens, 0)) AS BIGINT) AS output_tokens, CAST(sum(coalesce(total_tokens, 0)) AS BIGINT) AS total_tokens,
        CAST(round(CAST(sum(duration_ms) / CAST(count(duration_ms) AS DECIMAL(18, 0)) AS DECIMAL(22, 6)), 2) AS DOUBLE) AS avg_duration_ms FROM r_span GROUP BY 1, 2, 3, 4""",
    ),
)
def traces_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.traces_daily(spans_of(spark, sf_dir))


@query(
    "funnel_daily",
    _sql(
        [*SPAN_VIEWS, "b_cost", "b_audit"],
        SPANS,
        """SELECT date_key, cloud, audit_events, audit_users, invocations, tokens, resource_cost, currency FROM
        (SELECT date_key, 'm365' AS cloud, count(*) AS audit_events, count(DISTINCT user_key) AS audit_users FROM b_audit GROUP BY 1)
        FULL JOIN (SELECT s.date_key, a.cloud, count(*) FILTER (WHERE operation_name = 'invoke_agent') AS invocations, CAST(sum(coalesce(total_tokens, 0)) AS BIGINT) AS tokens
                   FROM r_span s JOIN b_agent a USING (agent_key) GROUP BY 1, 2) USING (date_key, cloud)
        FULL JOIN (SELECT date_key, cloud, sum(CAST(coalesce(effective_cost, billed_cost, 0) AS DECIMAL(18, 2))) AS resource_cost, max(currency) AS currency FROM b_cost GROUP BY 1, 2) USING (date_key, cloud)""",
    ),
)
def funnel_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    agents = bound(spark, sf_dir, "b_agent")
    return views.funnel_daily(audit_of(spark, sf_dir), spans_of(spark, sf_dir), agents, bound(spark, sf_dir, "b_cost"))


@query("agent_scorecard", _sql([*SPAN_VIEWS, "b_cost", "b_audit"], SPANS, AUDIT, ALLOCATION, CARD, "SELECT * FROM card"))
def agent_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scorecard_of(spark, sf_dir)


@query(
    "dup_clusters",
    _sql(
        [*SPAN_VIEWS, "b_cost", "b_audit"],
        SPANS,
        AUDIT,
        ALLOCATION,
        CARD,
        """SELECT c.config_hash, count(*) AS members, string_agg(DISTINCT c.agent_type, ', ' ORDER BY c.agent_type) AS agent_types, min(c.agent_name) AS sample_name,
        count(*) FILTER (WHERE has_usage_signal) AS used_members, CAST(sum(audit_events) AS BIGINT) AS total_audit_events, CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
        CAST(sum(allocated_cost_eur) AS DECIMAL(38, 6)) AS allocated_cost_eur, left(max(a.instructions), 300) AS prompt_sample
        FROM card c JOIN b_agent a USING (agent_key) WHERE in_dup_cluster GROUP BY 1""",
    ),
)
def dup_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.dup_clusters(scorecard_of(spark, sf_dir), bound(spark, sf_dir, "b_agent"))


@query("agent_cost_method", _sql(["b_agent"], METHOD, "SELECT * FROM method"))
def agent_cost_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.cost_methods(bound(spark, sf_dir, "b_agent"), views.method_map(spark))


UNIFIED_VIEWS = [*SPAN_VIEWS, "b_cost", "b_audit", "b_credits"]


@query("unified_cost", _sql(UNIFIED_VIEWS, SPANS, AUDIT, ALLOCATION, METHOD, UNIFIED, "SELECT * FROM unified"))
def unified_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unified_of(spark, sf_dir)


@query(
    "additive_total",
    _sql(
        UNIFIED_VIEWS, SPANS, AUDIT, ALLOCATION, METHOD, UNIFIED,
        """SELECT CAST(sum(allocated_cost) FILTER (WHERE cost_quality <> 'rated_included') AS DECIMAL(38, 6)) AS additive_total,
        CAST(sum(allocated_cost) FILTER (WHERE cost_quality = 'rated_included') AS DECIMAL(38, 6)) AS memo_total FROM unified""",
    ),
)
def additive_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.additive_total(unified_of(spark, sf_dir))


# --- facts, keys and upserts --------------------------------------------------------------------------------------


@query(
    "consumption_unpivot",
    _sql(
        SPAN_VIEWS,
        SPANS,
        """SELECT agent_key, model_key, date_key, span_id, resolution_tier, metric, value, CAST(resolution_tier <> 'unattributed' AS INT) AS attributed FROM (
        SELECT *, 'input_tokens' AS metric, CAST(input_tokens AS DOUBLE) AS value FROM r_span UNION ALL SELECT *, 'output_tokens', CAST(output_tokens AS DOUBLE) FROM r_span
        UNION ALL SELECT *, 'total_tokens', CAST(total_tokens AS DOUBLE) FROM r_span) WHERE value IS NOT NULL""",
    ),
)
def consumption_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.consumption(spans_of(spark, sf_dir), ["input_tokens", "output_tokens", "total_tokens"])


@query("snapshot_rollup", "SELECT l_suppkey AS agent_key, l_returnflag AS metric, CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INT) AS date_key, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS value_sum, count(*) AS value_count FROM lineitem GROUP BY 1, 2, 3")
def snapshot_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    consumed = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("agent_key"), F.col("l_returnflag").alias("metric"), x.date_key("l_shipdate").alias("date_key"), F.col("l_quantity").cast("decimal(18,2)").alias("value")
    )
    return facts.snapshot(consumed)


@query("dedup_first", "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS r FROM events) WHERE r = 1")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.keep_first(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["event_id"]).select("user_id", "event_type", "event_id")


@query("dedup_last", _sql(["b_cost"], " SELECT cloud, resource_id, date_key, meter_name, max(line) AS line FROM b_cost GROUP BY 1, 2, 3, 4"))
def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ["cloud", "resource_id", "date_key", "meter_name"]
    return quality.keep_last(bound(spark, sf_dir, "b_cost"), key, ["line"]).select(*key, "line")


@query("composite_keys", "SELECT event_id, sha256(CAST(user_id AS VARCHAR) || ':' || CASE WHEN event_id % 3 = 0 THEN 'None' ELSE event_type END) AS dedup_key FROM events")
def composite_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("kind", F.when(F.col("event_id") % 3 != 0, F.col("event_type")))
    return events.select("event_id", quality.dedup_key(["user_id", "kind"]).alias("dedup_key"))


@query(
    "upsert_update_sets",
    """SELECT trace_id, span_id, CASE WHEN n.span_id IS NOT NULL THEN n.agent_key ELSE o.agent_key END AS agent_key,
    CASE WHEN o.span_id IS NOT NULL THEN o.status ELSE n.status END AS status, CASE WHEN n.span_id IS NOT NULL THEN n.total_tokens ELSE o.total_tokens END AS total_tokens FROM
    (SELECT event_id AS span_id, event_id // 5 AS trace_id, user_id AS agent_key, event_type AS status, CAST(floor(value) AS BIGINT) AS total_tokens FROM events WHERE event_id % 3 <> 0) o
    FULL JOIN (SELECT event_id AS span_id, event_id // 5 AS trace_id, user_id + 1 AS agent_key, 'late' AS status, CAST(floor(value * 2) AS BIGINT) AS total_tokens FROM events WHERE event_id % 2 = 0) n
    USING (trace_id, span_id)""",
)
def upsert_update_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("trace_id", F.expr("event_id div 5"))
    old = events.where("event_id % 3 <> 0").select("trace_id", F.col("event_id").alias("span_id"), F.col("user_id").alias("agent_key"), F.col("event_type").alias("status"), F.floor("value").cast("long").alias("total_tokens"))
    new = events.where("event_id % 2 = 0").select("trace_id", F.col("event_id").alias("span_id"), (F.col("user_id") + 1).alias("agent_key"), F.lit("late").alias("status"), F.floor(F.col("value") * 2).cast("long").alias("total_tokens"))
    return facts.upsert(old, new, ["trace_id", "span_id"], facts.UPDATE_SETS["fact_agent_traces"])


@query(
    "dim_merge",
    """SELECT coalesce(o.k, n.k) AS native_id, coalesce(n.a, o.a) AS agent_name, coalesce(n.t, o.t) AS agent_type FROM
    (SELECT c_custkey AS k, c_name AS a, c_mktsegment AS t FROM customer WHERE c_custkey % 3 <> 0) o
    FULL JOIN (SELECT k, arg_min(a, s) AS a, arg_min(t, s) AS t FROM (SELECT c_custkey AS k, coalesce(NULL, c_name || '*') AS a, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'new' END AS t, c_acctbal AS s FROM customer WHERE c_custkey % 2 = 0) WHERE t IS NOT NULL GROUP BY k
               UNION ALL SELECT c_custkey, c_name || '*', NULL FROM customer WHERE c_custkey % 4 = 0) n ON o.k = n.k""",
)
def dim_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    old = customers.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("native_id"), F.col("c_name").alias("agent_name"), F.col("c_mktsegment").alias("agent_type"))
    new = customers.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("native_id"), F.concat("c_name", F.lit("*")).alias("agent_name"), F.when(F.col("c_custkey") % 4 != 0, "new").alias("agent_type"), "c_acctbal")
    return facts.merge_newest(old, new, ["native_id"], ["c_acctbal"])


@query("dim_keys", "SELECT count(*) AS keys, count(DISTINCT user_id) AS naturals, CAST(min(rank) AS BIGINT) AS low, CAST(max(rank) AS BIGINT) AS high FROM (SELECT user_id, dense_rank() OVER (ORDER BY user_id) AS rank FROM (SELECT DISTINCT user_id FROM events))")
def dim_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers for users: half of them known, the others new; numbers are dense and distinct."""
    users = table(spark, sf_dir, "events").select("user_id")
    none = users.where("false").select("user_id", F.lit(0).cast("long").alias("user_key"))
    known = facts.with_keys(none, users.where("user_id % 2 = 0"), ["user_id"], "user_key")
    keys = facts.with_keys(known, users, ["user_id"], "user_key")
    return keys.agg(F.countDistinct("user_key").alias("keys"), F.countDistinct("user_id").alias("naturals"), F.min("user_key").alias("low"), F.max("user_key").alias("high"))


@query("dim_date", "SELECT DISTINCT k AS date_key, CAST(k // 10000 AS INT) AS year, CAST(k // 100 % 100 AS INT) AS month, CAST(k % 100 AS INT) AS day FROM (SELECT CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INT) AS k FROM events)")
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.dim_date(x.date_key("ts"), table(spark, sf_dir, "events"))


@query("bridges", "SELECT DISTINCT o_custkey AS agent_key, trim(s) AS skill FROM (SELECT o_custkey, unnest(string_split(o_orderpriority, '-')) AS s FROM orders)")
def bridges(spark: SparkSession, sf_dir: str) -> DataFrame:
    skills = F.explode(F.array_distinct(F.split("o_orderpriority", "-")))
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("agent_key"), skills.alias("s")).select("agent_key", F.trim("s").alias("skill")).dropDuplicates()


@query("prompt_backfill", _sql(["b_agent"], ", d AS (SELECT concat('agent', c_custkey) AS id, max(c_name) AS t FROM customer GROUP BY 1) SELECT a.agent_key, CASE WHEN a.cloud = 'm365' AND coalesce(a.instructions, '') = '' THEN coalesce(d.t, a.instructions) ELSE a.instructions END AS instructions FROM b_agent a LEFT JOIN d ON d.id = a.native_agent_id"))
def prompt_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = table(spark, sf_dir, "customer").select(F.concat(F.lit("agent"), "c_custkey").alias("native_agent_id"), F.col("c_name").alias("instructions"))
    return facts.fill_prompts(bound(spark, sf_dir, "b_agent"), details).select("agent_key", "instructions")


# --- validation, checks and reshaping -----------------------------------------------------------------------------


@query("validate_split", "SELECT event_type, count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS invalid FROM (SELECT event_type, event_id % 7 <> 0 AND event_type IN ('click', 'view', 'purchase', 'signup') AS ok FROM events) GROUP BY 1")
def validate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("key", F.when(F.col("event_id") % 7 != 0, F.col("event_id")))
    valid, invalid = quality.validate(rows, ["key"], {"value": "double"}, {"event_type": ["click", "view", "purchase", "signup"]})
    kinds = valid.groupBy("event_type").agg(F.count("*").alias("valid"))
    lost = invalid.groupBy(F.get_json_object("raw", "$.event_type").alias("event_type")).agg(F.count("*").alias("invalid"))
    return kinds.join(lost, "event_type", "full").select("event_type", F.coalesce("valid", F.lit(0)).alias("valid"), F.coalesce("invalid", F.lit(0)).alias("invalid"))


@query("run_stats", "SELECT count(DISTINCT (user_id, event_type)) FILTER (WHERE ok) AS kept, count(*) FILTER (WHERE ok) - count(DISTINCT (user_id, event_type)) FILTER (WHERE ok) AS duplicates, count(*) FILTER (WHERE NOT ok) AS invalid, count(*) FILTER (WHERE ok AND event_id % 2 = 0) AS drifted FROM (SELECT *, event_id % 7 <> 0 AS ok FROM events)")
def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_stats(table(spark, sf_dir, "events"), ["user_id", "event_type"], F.col("event_id") % 7 != 0, F.col("event_id") % 2 == 0)


@query(
    "orphan_checks",
    """SELECT 'orders_customer' AS check_name, count(*) AS orphans FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)
    UNION ALL SELECT 'lineitem_orders', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'labels_documents', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE source <> 'src0')""",
)
def orphan_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    return quality.orphans(
        [
            ("orders_customer", t("orders"), "o_custkey", t("customer").where("c_custkey % 10 <> 0"), "c_custkey", False),
            ("lineitem_orders", t("lineitem"), "l_orderkey", t("orders"), "o_orderkey", False),
            ("labels_documents", t("labels"), "doc_id", t("documents").where("source <> 'src0'"), "doc_id", True),
        ]
    )


@query("reconcile_orphans", "SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents WHERE lang <> 'de'")
def reconcile_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reconcile_orphans(table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents").where("lang <> 'de'"), "doc_id")


@query("drift_capture", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{\"k\":\"' || json_extract_string(props, '$.k') || '\",\"z\":\"' || event_type || '\"}' END AS _drift FROM events")
def drift_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undeclared keys of a record as sorted JSON."""
    known = F.create_map(F.lit("user_id"), F.col("user_id").cast("string"))
    extra = F.create_map(F.lit("z"), F.col("event_type"), F.lit("k"), F.get_json_object("props", "$.k"))
    record = F.when(F.col("event_id") % 2 == 0, F.map_concat(known, extra)).otherwise(known)
    return table(spark, sf_dir, "events").select("event_id", quality.drift(record, ["user_id"]).alias("_drift"))


@query("ghost_dedupe", _sql(["b_agent"], ", p AS (SELECT agent_key, agent_type AS n, cloud AS c, owner_id AS o FROM b_agent WHERE agent_key > 0), z AS (SELECT '00000000-0000-0000-0000-000000000000' AS g) SELECT agent_key FROM p, z WHERE coalesce(o, g) <> g OR NOT EXISTS (SELECT 1 FROM p q WHERE coalesce(q.o, g) <> g AND q.n IS NOT DISTINCT FROM p.n AND q.c IS NOT DISTINCT FROM p.c)"))
def ghost_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = bound(spark, sf_dir, "b_agent").where("agent_key > 0").select("agent_key", F.col("agent_type").alias("display_name"), F.col("cloud").alias("platform"), "owner_id")
    return quality.ghosts_dropped(packages, "00000000-0000-0000-0000-000000000000").select("agent_key")


@query("wide_to_long", "SELECT o_orderkey, workload, CAST(v AS INT) AS active_users FROM (SELECT o_orderkey, 'Exchange' AS workload, CAST(o_custkey AS VARCHAR) AS v FROM orders UNION ALL SELECT o_orderkey, 'Teams', CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE CAST(o_orderkey % 50 AS VARCHAR) END FROM orders) WHERE trim(v) <> ''")
def wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("Exchange"), F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise((F.col("o_orderkey") % 50).cast("string")).alias("Teams"))
    return flatten.wide_to_long(wide, ["o_orderkey"], ["Exchange", "Teams"], "workload", "active_users")


@query(
    "credits_enrich",
    """SELECT a.event_id, a.user_id AS person_id, CAST(a.value AS DECIMAL(18, 2)) AS credits, p.licensed, coalesce(p.organization, '') AS organization FROM (SELECT * FROM events WHERE event_type <> 'signup') a
    LEFT JOIN (SELECT user_id, arg_max(event_id % 2 = 0, event_id) AS licensed, arg_max('org' || CAST(event_id % 5 AS VARCHAR), event_id) AS organization FROM events WHERE event_type = 'signup' GROUP BY 1) p ON p.user_id = a.user_id""",
)
def credits_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = F.col("event_type") == "signup"
    mixed = table(spark, sf_dir, "events").select(
        F.when(people, "people").otherwise("activity").alias("kind"), F.col("user_id").alias("person_id"), "event_id", F.col("value").cast("decimal(18,2)").alias("credits"),
        F.when(people, F.concat(F.lit("org"), F.col("event_id") % 5)).alias("organization"), F.when(people, F.col("event_id") % 2 == 0).alias("licensed"),
    )
    return facts.credits_with_people(mixed, "event_id").select("event_id", "person_id", "credits", "licensed", "organization")


@query("agents_from_spans", _sql(["b_agent", "b_span"], " SELECT DISTINCT 'azure' AS cloud, coalesce(NULLIF(CASE WHEN span_id % 2 = 0 THEN caller_id ELSE '' END, ''), native_agent_id) AS native_agent_id FROM b_span WHERE coalesce(NULLIF(CASE WHEN span_id % 2 = 0 THEN caller_id ELSE '' END, ''), native_agent_id) NOT IN (SELECT native_agent_id FROM b_agent WHERE cloud = 'azure')"))
def agents_from_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = bound(spark, sf_dir, "b_span").withColumn("service_name", F.when(F.col("span_id") % 2 == 0, F.col("caller_id")).otherwise(""))
    return facts.agents_from_spans(spans, bound(spark, sf_dir, "b_agent"), "azure")


@query("metric_consumption", _sql(["b_agent"], " SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(-1 AS BIGINT) ELSE CAST(-2 AS BIGINT) END AS agent_key, 0 AS attributed, 'unattributed' AS resolution_tier FROM events"))
def metric_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, "aws").otherwise("azure").alias("cloud"))
    return facts.metric_consumption(metrics, bound(spark, sf_dir, "b_agent")).select("event_id", "agent_key", "attributed", "resolution_tier")


@query("cost_fact", _sql(["b_cost"], " SELECT cloud, resource_id, date_key, coalesce(CASE WHEN line % 5 = 0 THEN NULL ELSE meter_name END, '') AS meter_name, max(line) AS line, 'metered' AS cost_basis FROM b_cost WHERE line % 11 <> 0 GROUP BY 1, 2, 3, 4"))
def cost_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = bound(spark, sf_dir, "b_cost").withColumn("meter_name", F.when(F.col("line") % 5 != 0, F.col("meter_name"))).withColumn("resource_id", F.when(F.col("line") % 11 != 0, F.col("resource_id")))
    return facts.cost_fact(lines, "line").select("cloud", "resource_id", "date_key", "meter_name", "line", "cost_basis")


@query("prototype_loader", _sql(SPAN_VIEWS, SPANS, "SELECT metric, count(*) AS n, count(*) AS attributed FROM (SELECT 'input_tokens' AS metric, input_tokens AS v FROM r_span UNION ALL SELECT 'output_tokens', output_tokens FROM r_span) WHERE v IS NOT NULL GROUP BY 1"))
def prototype_loader(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = facts.prototype_consumption(spans_of(spark, sf_dir), ["input_tokens", "output_tokens"])
    return rows.groupBy("metric").agg(F.count("*").alias("n"), F.sum("attributed").alias("attributed"))


@query("prototype_registry", "SELECT c_nationkey AS native_agent_id, min(c_custkey) AS first_row FROM customer GROUP BY 1")
def prototype_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = table(spark, sf_dir, "customer").select(F.lit("m365").alias("cloud"), F.col("c_nationkey").alias("native_agent_id"), F.col("c_custkey").alias("first_row"))
    return facts.prototype_agents(batch, ["first_row"]).select("native_agent_id", "first_row")


@query("restatement", "SELECT event_id AS id, CASE WHEN day(ts) BETWEEN 10 AND 14 AND event_id % 2 = 0 THEN 'restated' ELSE event_type END AS kind, CAST(day(ts) AS INT) AS d FROM events")
def restatement(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.dayofmonth("ts").alias("d"))
    return facts.restated(rows, rows.where("id % 2 = 0").withColumn("kind", F.lit("restated")), ["id"], "d", 10, 14)


@query("billed_variance", "SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER (WHERE o_orderstatus = 'F') AS billed, sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER (WHERE o_orderstatus <> 'F') AS estimated, coalesce(sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER (WHERE o_orderstatus = 'F'), 0) - coalesce(sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER (WHERE o_orderstatus <> 'F'), 0) AS variance FROM orders GROUP BY 1")
def billed_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "orders").select("o_custkey", F.when(F.col("o_orderstatus") == "F", "billed").otherwise("estimated").alias("cost_source"), F.col("o_totalprice").cast("decimal(18,2)").alias("cost"))
    return measures.billed_variance(lines, ["o_custkey"])


@query("owner_licences", _sql(["b_agent"], " SELECT l.owner_id, licences, coalesce(agents, 0) AS agents FROM (SELECT 'owner' || CAST(user_id % 20 AS VARCHAR) AS owner_id, count(*) AS licences FROM events WHERE event_type = 'signup' GROUP BY 1) l LEFT JOIN (SELECT owner_id, count(*) AS agents FROM b_agent GROUP BY 1) a ON a.owner_id = l.owner_id"))
def owner_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    licences = table(spark, sf_dir, "events").where("event_type = 'signup'").select(F.concat(F.lit("owner"), F.col("user_id") % 20).alias("owner_id"))
    return measures.owner_licences(bound(spark, sf_dir, "b_agent"), licences)


@query("content_windows", "SELECT event_id, CAST(date_diff('second', s, n) AS BIGINT) AS back, CAST(date_diff('second', s, least(s + INTERVAL 24 HOUR, n)) AS BIGINT) AS length FROM (SELECT event_id, n, greatest(coalesce(CASE WHEN event_id % 3 <> 0 THEN date_trunc('second', ts) END, n - INTERVAL 6 HOUR), n - INTERVAL 7 DAY + INTERVAL 10 MINUTE) AS s FROM (SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS n FROM events))")
def content_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan windows of a content feed by cursor: how far back they start, and how long they are."""
    now = F.expr("TIMESTAMP '2024-02-01 00:00:00'")
    start = x.content_window_start(F.when(F.col("event_id") % 3 != 0, F.date_trunc("second", "ts").cast("timestamp")), now)
    seconds = lambda a, b: F.unix_timestamp(b) - F.unix_timestamp(a)
    return table(spark, sf_dir, "events").select("event_id", seconds(start, now).alias("back"), seconds(start, x.content_window_end(start, now)).alias("length"))

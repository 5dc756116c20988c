"""Registered queries of measures, calendar, hierarchy, rankings and census."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.functions import expressions as x
from fleetspark.plans import census, measures, views
from fleetspark.plans.bind import bound
from fleetspark.plans.catalog import ALLOCATION, AUDIT, CARD, SPANS, SPAN_VIEWS, _sql, allocation_of, audit_of, scorecard_of, spans_of, table
from fleetspark.plans.registry import query


@query(
    "kpis_cost",
    _sql(
        [*SPAN_VIEWS, "b_cost"], SPANS, ALLOCATION,
        """SELECT resource_cost, allocated_cost, unallocated_cost, tokens, invocations, round(tokens / 1e6, 6) AS tokens_m,
        CASE WHEN resource_cost <> 0 THEN round(CAST(allocated_cost AS DOUBLE) / CAST(resource_cost AS DOUBLE), 6) END AS pct_allocated,
        CASE WHEN tokens <> 0 THEN round(CAST(allocated_cost AS DOUBLE) * 1e6 / tokens, 6) END AS cost_per_1m_tokens, CASE WHEN invocations <> 0 THEN round(CAST(allocated_cost AS DOUBLE) / invocations, 6) END AS cost_per_invocation
        FROM (SELECT sum(CAST(coalesce(effective_cost, billed_cost, 0) AS DECIMAL(18, 2))) AS resource_cost FROM b_cost),
        (SELECT CAST(sum(allocated_cost) FILTER (WHERE cost_basis = 'allocated') AS DECIMAL(38, 6)) AS allocated_cost, CAST(sum(allocated_cost) FILTER (WHERE cost_basis = 'unallocated') AS DECIMAL(38, 6)) AS unallocated_cost,
                CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(invocations) AS BIGINT) AS invocations FROM allocation)""",
    ),
)
def kpis_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.cost_kpis(bound(spark, sf_dir, "b_cost"), allocation_of(spark, sf_dir))


@query(
    "kpis_usage",
    _sql(
        [*SPAN_VIEWS, "b_audit"], SPANS,
        """SELECT count(*) AS usage_events, count(DISTINCT user_key) AS active_users, count(*) FILTER (WHERE dlp_evaluation_deferred = 1) AS dlp_deferred,
        (SELECT count(*) FROM r_span WHERE status SIMILAR TO '[45].*') AS trace_errors FROM b_audit""",
    ),
)
def kpis_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.usage_kpis(views.usage_daily(audit_of(spark, sf_dir)), views.traces_daily(spans_of(spark, sf_dir)))


@query(
    "kpis_catalogue",
    _sql(
        [*SPAN_VIEWS, "b_cost", "b_audit"], SPANS, AUDIT, ALLOCATION, CARD,
        """SELECT count(*) AS agents, count(*) FILTER (WHERE has_usage_signal) AS with_use, count(*) FILTER (WHERE tier = 'DECOMMISSION_CANDIDATE') AS candidates,
        count(*) FILTER (WHERE in_dup_cluster) AS in_clusters, round(CAST(count(*) FILTER (WHERE NOT has_usage_signal) AS DOUBLE) / count(*), 6) AS pct_unused FROM card""",
    ),
)
def kpis_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.catalogue_kpis(scorecard_of(spark, sf_dir))


@query(
    "cost_hierarchy",
    _sql(
        ["b_cost"],
        """ SELECT s AS subscription_id, g AS resource_group, meter_name, sum(c) AS cost, CAST(grouping(s, g, meter_name) AS BIGINT) AS level FROM
        (SELECT regexp_extract(resource_id, 'subscriptions/([^/]+)', 1) AS s, regexp_extract(resource_id, 'resourceGroups/([^/]+)', 1) AS g, meter_name,
                CAST(coalesce(effective_cost, billed_cost, 0) AS DECIMAL(18, 2)) AS c FROM b_cost) GROUP BY ROLLUP (s, g, meter_name)""",
    ),
)
def cost_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.cost_hierarchy(bound(spark, sf_dir, "b_cost"))


@query("top_resources", _sql(["b_cost"], " SELECT resource_id, sum(CAST(coalesce(effective_cost, billed_cost, 0) AS DECIMAL(18, 2))) AS cost FROM b_cost GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"))
def top_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    spent = bound(spark, sf_dir, "b_cost").groupBy("resource_id").agg(F.sum(x.effective_cost()).alias("cost"))
    return measures.top(spent, "cost", "resource_id", 20)


@query("calendar_days", "SELECT strftime(d, '%Y-%m-%d') AS day, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, CAST(dayofweek(d) + 1 AS INT) AS day_of_week, CAST((dayofweek(d) + 6) % 7 AS INT) AS weekday FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS d FROM orders)")
def calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.calendar(table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")))


@query(
    "prev_business_day",
    """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
    c AS (SELECT CAST(unnest(generate_series(min(day) - 40, max(day), INTERVAL 1 DAY)) AS DATE) AS b FROM d)
    SELECT strftime(day, '%Y-%m-%d') AS day, strftime(max(b), '%Y-%m-%d') AS previous FROM d JOIN c ON b < day AND b >= day - 12 AND dayofweek(b) BETWEEN 1 AND 5 AND strftime(b, '%Y-%m-%d') NOT IN ('1996-01-01', '1996-12-25') GROUP BY 1""",
)
def prev_business_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.previous_business_day(table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")), ["1996-01-01", "1996-12-25"])


@query("date_chunks", "SELECT o_orderkey AS id, strftime(s, '%Y-%m-%d') AS chunk_start, strftime(least(s + INTERVAL 6 DAY, stop), '%Y-%m-%d') AS chunk_stop FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INT) AS stop, unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INT), INTERVAL 7 DAY)) AS s FROM orders)")
def date_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.to_date("o_orderdate")
    return measures.chunks(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), start.alias("start"), F.date_add(start, (F.col("o_orderkey") % 30).cast("int")).alias("stop")), 7)


@query("late_window", "SELECT event_id FROM events WHERE CAST(ts AS DATE) BETWEEN (SELECT max(CAST(ts AS DATE)) FROM events) - 2 AND (SELECT max(CAST(ts AS DATE)) FROM events)")
def late_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the three days in which late reports are read again."""
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max(F.to_date("ts")).alias("target"))
    day = F.to_date("ts")
    return events.crossJoin(F.broadcast(last)).where((day >= x.window_start("target")) & (day <= F.col("target"))).select("event_id")  # one row


@query("cost_anomaly", _sql(["b_cost"], ", d AS (SELECT cloud, date_key, sum(CAST(coalesce(effective_cost, billed_cost, 0) AS DECIMAL(18, 2))) AS cost FROM b_cost GROUP BY 1, 2) SELECT cloud, date_key, cost, row_number() OVER (PARTITION BY cloud ORDER BY date_key) <= 10 AS baseline_period FROM d"))
def cost_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = bound(spark, sf_dir, "b_cost").groupBy("cloud", "date_key").agg(F.sum(x.effective_cost()).alias("cost"))
    return measures.cost_anomalies(daily, ["cloud"], 10).drop("z_score")


@query(
    "cost_anomaly_scores",
    _sql(
        ["b_cost"],
        """, d AS (SELECT cloud, date_key, sum(CAST(coalesce(effective_cost, billed_cost, 0) AS DECIMAL(18, 2))) AS cost FROM b_cost GROUP BY 1, 2),
        w AS (SELECT *, CAST(cost AS DOUBLE) AS c, row_number() OVER (PARTITION BY cloud ORDER BY date_key) AS i,
            avg(CAST(cost AS DOUBLE)) OVER (PARTITION BY cloud ORDER BY date_key ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS m,
            stddev_samp(CAST(cost AS DOUBLE)) OVER (PARTITION BY cloud ORDER BY date_key ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS s FROM d)
        SELECT cloud, date_key, cost, i <= 30 AS baseline_period, round((c - m) / nullif(s, 0), 4) AS z_score FROM w""",
    ),
)
def cost_anomaly_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = bound(spark, sf_dir, "b_cost").groupBy("cloud", "date_key").agg(F.sum(x.effective_cost()).alias("cost"))
    return measures.cost_anomalies(daily, ["cloud"])


@query("unobserved_agents", _sql(["b_agent", "b_audit"], AUDIT, "SELECT a.agent_key, l AS last_day, CAST(date_diff('day', strptime(CAST(l AS VARCHAR), '%Y%m%d'), DATE '2024-01-31') AS INT) AS days_since FROM b_agent a LEFT JOIN (SELECT agent_key, max(date_key) AS l FROM r_audit GROUP BY 1) USING (agent_key) WHERE cloud = 'm365' AND agent_key > 0 AND (l IS NULL OR date_diff('day', strptime(CAST(l AS VARCHAR), '%Y%m%d'), DATE '2024-01-31') > 1)"))
def unobserved_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.unobserved(bound(spark, sf_dir, "b_agent"), audit_of(spark, sf_dir), 20240131, 1)


@query("identity_census", "SELECT 'events' AS table_name, count(*) AS rows, count(user_id) AS user_id, count(*) FILTER (WHERE event_type <> '') AS event_type, CAST(0 AS BIGINT) AS lang FROM events UNION ALL SELECT 'documents', count(*), 0, 0, count(*) FILTER (WHERE lang <> '') FROM documents")
def identity_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census.filled({"events": table(spark, sf_dir, "events"), "documents": table(spark, sf_dir, "documents")}, ["user_id", "event_type", "lang"])


@query("json_census", "SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS key FROM events) WHERE key LIKE '%k%' GROUP BY 1")
def json_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census.bag_keys(table(spark, sf_dir, "events"), "props", "k")


@query("volume_census", "SELECT event_type, count(*) AS n, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen FROM events GROUP BY 1")
def volume_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census.volume(table(spark, sf_dir, "events"), ["event_type"], "ts")


@query("sample_rows", "SELECT event_id, user_id FROM events WHERE event_type = 'error' ORDER BY event_id LIMIT 50")
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census.samples(table(spark, sf_dir, "events"), "event_type = 'error'", ["event_id"], 50).select("event_id", "user_id")


@query("identity_verdict", _sql(SPAN_VIEWS[2:], " SELECT rows, column_name, present, CASE WHEN present = 0 THEN 'absent' WHEN present = rows THEN 'present' ELSE 'partial' END AS verdict FROM (SELECT count(*) AS rows, 'native_agent_id' AS column_name, count(native_agent_id) AS present FROM b_span UNION ALL SELECT count(*), 'caller_id', count(caller_id) FROM b_span)"))
def identity_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census.verdict(bound(spark, sf_dir, "b_span"), ["native_agent_id", "caller_id"])

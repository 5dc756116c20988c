"""Registered queries of the star's loads, checks and rankings, of file sources and sinks, and of scalar helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.functions import expressions as x
from fleetspark.operators import facts, flatten, star
from fleetspark.plans import census, measures
from fleetspark.plans.bind import bound
from fleetspark.plans.catalog import ALLOCATION, AUDIT, CARD, SPANS, SPAN_VIEWS, _sql, allocation_of, audit_of, scorecard_of, spans_of, table
from fleetspark.plans.registry import query
from fleetspark.plans.source_loads import _first, _valid
from fleetspark.sources import landing, pipelines
from fleetspark.sources.scratch import folder

# --- checks --------------------------------------------------------------------------------------------------------

_STAR_TABLES = {
    "fact_agent_consumption": "SELECT agent_key, 'input_tokens' AS metric_key, model_key, date_key FROM r_span WHERE input_tokens IS NOT NULL UNION ALL SELECT agent_key, 'output_tokens', model_key, date_key FROM r_span WHERE output_tokens IS NOT NULL UNION ALL SELECT agent_key, 'total_tokens', model_key, date_key FROM r_span WHERE total_tokens IS NOT NULL",
    "dim_agent": "SELECT agent_key FROM b_agent WHERE agent_key % 10 <> 3",
    "dim_metric": "SELECT DISTINCT CASE WHEN event_id % 2 = 0 THEN 'input_tokens' ELSE 'total_tokens' END AS metric_key FROM events",
    "dim_model": "SELECT DISTINCT model_key FROM b_span WHERE model_key <> 'gpt-7'",
    "dim_date": "SELECT DISTINCT date_key FROM b_span WHERE date_key % 10 <> 5",
    "bridge_agent_skill": "SELECT o_custkey AS agent_key, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderpriority END AS skill_key FROM orders",
    "dim_skill": "SELECT DISTINCT o_orderpriority AS skill_key FROM orders WHERE o_orderpriority <> '5-LOW'",
    "bridge_agent_connector": "SELECT o_custkey AS agent_key, o_orderstatus AS connector_key FROM orders",
    "dim_connector": "SELECT DISTINCT o_orderstatus AS connector_key FROM orders WHERE o_orderstatus <> 'P'",
    "fact_resource_cost": "SELECT date_key FROM b_cost",
    "fact_agent_audit": "SELECT agent_key, date_key, CASE WHEN record_id % 9 <> 0 THEN user_key END AS user_key FROM r_audit",
    "dim_user": "SELECT DISTINCT user_key FROM b_audit WHERE user_key % 5 <> 0",
}
_CHECK_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, count(*) AS orphans FROM {child} c LEFT JOIN {parent} p ON p.{key} = c.{key} WHERE p.{key} IS NULL" + (f" AND c.{key} IS NOT NULL" if optional else "")
    for name, child, key, parent, optional in star.STAR_CHECKS
)


@query("star_orphans", _sql([*SPAN_VIEWS, "b_cost", "b_audit"], SPANS, AUDIT, ", " + ", ".join(f"{n} AS ({s})" for n, s in _STAR_TABLES.items()) + " ", _CHECK_SQL))
def star_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve declared checks, over dimensions that lack some rows."""
    spans, agents, events, orders = spans_of(spark, sf_dir), bound(spark, sf_dir, "b_agent"), table(spark, sf_dir, "events"), table(spark, sf_dir, "orders")
    audit = audit_of(spark, sf_dir)
    consumed = facts.consumption(spans, ["input_tokens", "output_tokens", "total_tokens"])
    return star.star_checks(
        {
            "fact_agent_consumption": consumed.withColumnRenamed("metric", "metric_key"),
            "dim_agent": agents.where("agent_key % 10 <> 3"),
            "dim_metric": events.select(F.when(F.col("event_id") % 2 == 0, "input_tokens").otherwise("total_tokens").alias("metric_key")).distinct(),
            "dim_model": bound(spark, sf_dir, "b_span").where("model_key <> 'gpt-7'").select("model_key").distinct(),
            "dim_date": facts.dim_date(F.col("date_key"), bound(spark, sf_dir, "b_span")).where("date_key % 10 <> 5"),
            "bridge_agent_skill": orders.select(F.col("o_custkey").alias("agent_key"), F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderpriority")).alias("skill_key")),
            "dim_skill": orders.where("o_orderpriority <> '5-LOW'").select(F.col("o_orderpriority").alias("skill_key")).distinct(),
            "bridge_agent_connector": orders.select(F.col("o_custkey").alias("agent_key"), F.col("o_orderstatus").alias("connector_key")),
            "dim_connector": orders.where("o_orderstatus <> 'P'").select(F.col("o_orderstatus").alias("connector_key")).distinct(),
            "fact_resource_cost": bound(spark, sf_dir, "b_cost"),
            "fact_agent_audit": audit.withColumn("user_key", F.when(F.col("record_id") % 9 != 0, F.col("user_key"))),
            "dim_user": bound(spark, sf_dir, "b_audit").where("user_key % 5 <> 0").select("user_key").distinct(),
        }
    )


_NOT_IN_CHILD = "(SELECT CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey END AS k FROM orders)"


@query(
    "orphans_not_in",
    f"""SELECT 'plain' AS check_name, count(*) AS orphans FROM {_NOT_IN_CHILD} WHERE k NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)
    UNION ALL SELECT 'null parent', count(*) FROM {_NOT_IN_CHILD} WHERE k NOT IN (SELECT CASE WHEN c_custkey % 10 <> 0 THEN c_custkey END FROM customer)""",
)
def orphans_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    child = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 4 != 0, F.col("o_custkey")).alias("k"))
    customers, some = table(spark, sf_dir, "customer"), F.col("c_custkey") % 10 != 0
    return star.orphans_not_in([("plain", child, "k", customers.where(some), "c_custkey"), ("null parent", child, "k", customers.select(F.when(some, F.col("c_custkey")).alias("p")), "p")])


@query("table_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")))
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")
    return census.filled({n: table(spark, sf_dir, n) for n in names}, []).select("table_name", "rows")


# --- facts and dimensions --------------------------------------------------------------------------------------------


@query(
    "span_facts_bedrock",
    _first(
        """'t' || h AS trace_id, 's' || h AS span_id, CASE WHEN event_id % 3 = 1 THEN 'p' || h END AS parent_span_id, CASE WHEN event_id % 2 = 0 THEN 'svc' || user_id WHEN event_id % 4 = 3 THEN 'a' || user_id END AS native_agent_id,
        CASE WHEN event_id % 3 <> 0 THEN 'm' || CAST(event_id % 5 AS VARCHAR) ELSE '(unknown)' END AS model, CAST(20231114 AS INT) AS date_key, event_type AS operation_name, 'CLIENT' AS span_kind, 'u' || user_id AS caller_id,
        CASE WHEN event_type = 'error' THEN 'boom' END AS status, event_id AS input_tokens, CAST(7 AS BIGINT) AS output_tokens, event_id + 7 AS total_tokens, CASE WHEN event_id % 5 = 1 THEN 'tool' END AS tool_name,
        CASE WHEN event_id % 4 = 1 THEN 'unattributed' ELSE 'native' END AS resolution_tier""",
        "event_id % 7 <> 0",
    ),
)
def span_facts_bedrock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From raw spans through the source's job to the fact; spans without a trace have no row."""
    attributes = """map_filter(map('gen_ai.request.model', if(event_id % 3 <> 0, concat('m', event_id % 5), NULL), 'session.id', concat('u', user_id), 'gen_ai.usage.input_tokens', string(event_id), 'gen_ai.usage.completion_tokens', '7',
        'gen_ai.agent.id', if(event_id % 4 = 3, concat('a', user_id), NULL), 'gen_ai.tool.name', if(event_id % 5 = 1, 'tool', NULL)), (k, v) -> v IS NOT NULL)"""
    text = f"""named_struct('spanId', if(event_id % 7 = 0, NULL, concat('s', event_id div 2)), 'traceId', concat('t', event_id div 2), 'parentSpanId', if(event_id % 3 = 1, concat('p', event_id div 2), NULL), 'name', event_type, 'kind', 'CLIENT',
        'startTimeUnixNano', '1700000000000000000', 'status', if(event_type = 'error', named_struct('code', 'STATUS_CODE_ERROR', 'message', 'boom'), NULL), 'attributes', {attributes}, 'resource', if(event_id % 2 = 0, named_struct('attributes', map('service.name', concat('svc', user_id))), NULL))"""
    return star.bedrock_span_fact(_valid(spark, sf_dir, "bedrock_traces", text)).drop("timestamp", "latency_ms")


def _cost_sql(where: str, currency: str) -> str:
    meter = "coalesce(nullif(trim(CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN '  ' ELSE o_orderpriority END), ''), '')"
    day = "CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INT)"
    return f"SELECT 'r' || CAST(o_custkey % 50 AS VARCHAR) AS resource_id, {day} AS date_key, {meter} AS meter_name, arg_max(o_totalprice, o_orderkey) AS billed_cost, arg_max(struct_pack(c := {currency}), o_orderkey).c AS currency FROM orders WHERE {where} GROUP BY 1, 2, 3"


@query(
    "cost_fact_load",
    f"""SELECT 'azure' AS cloud, coalesce(o.resource_id, n.resource_id) AS resource_id, coalesce(o.date_key, n.date_key) AS date_key, coalesce(o.meter_name, n.meter_name) AS meter_name,
    CASE WHEN n.resource_id IS NOT NULL THEN n.billed_cost ELSE o.billed_cost END AS billed_cost, CASE WHEN n.resource_id IS NOT NULL THEN n.currency ELSE o.currency END AS currency
    FROM ({_cost_sql("o_orderkey % 2 = 0", "'OLD'")}) o FULL JOIN ({_cost_sql("o_orderkey % 3 = 0", "CASE o_orderkey % 4 WHEN 0 THEN 'EUR' END")}) n ON o.resource_id = n.resource_id AND o.date_key = n.date_key AND o.meter_name = n.meter_name""",
)
def cost_fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose drift names a currency, is broken, is no object, or is missing, merged into what was loaded before."""
    orders = table(spark, sf_dir, "orders").withColumn("k5", F.col("o_orderkey") % 5)
    drift = F.expr("CASE o_orderkey % 4 WHEN 0 THEN '{\"currency\": \" EUR\"}' WHEN 1 THEN '{bad' WHEN 2 THEN '[1]' END")
    text = ["consumed_unit", "meter_category", "subscription_id", "resource_group"]
    records = orders.select(
        "o_orderkey", F.concat(F.lit("r"), F.col("o_custkey") % 50).alias("resource_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("charge_period_start"),
        F.when(F.col("k5") == 0, None).when(F.col("k5") == 1, "  ").otherwise(F.col("o_orderpriority")).alias("meter_name"), F.col("o_totalprice").alias("billed_cost"),
        *[F.lit(None).cast("double").alias(c) for c in ("effective_cost", "consumed_quantity")], *[F.lit(None).cast("string").alias(c) for c in text], drift.alias("_drift"),
    )
    lines = star.cost_lines(records, "azure")
    columns = ["cloud", "resource_id", "date_key", "meter_name", *facts.UPDATE_SETS["fact_resource_cost"]]
    loaded = star.load_cost(lines.where("false").select(columns), lines.where("o_orderkey % 2 = 0").withColumn("currency", F.lit("OLD")), "o_orderkey")
    return star.load_cost(loaded, lines.where("o_orderkey % 3 = 0"), "o_orderkey").select("cloud", "resource_id", "date_key", "meter_name", "billed_cost", "currency")


_CREDIT_ACTIVITY = "SELECT CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INT) AS date_key, user_id AS person_id, event_type AS service_id, arg_max(floor(value), event_id) AS credits FROM events WHERE event_type <> 'signup' AND {} GROUP BY 1, 2, 3"


@query(
    "credits_fact_load",
    f"""WITH people AS (SELECT user_id, arg_max('org' || CAST(event_id % 5 AS VARCHAR), event_id) AS organization, arg_max(event_id % 2 = 0, event_id) AS licensed FROM events WHERE event_type = 'signup' GROUP BY 1),
    o AS ({_CREDIT_ACTIVITY.format("event_id % 2 = 0")}), n AS ({_CREDIT_ACTIVITY.format("event_id % 3 = 0")})
    SELECT date_key, person_id, service_id, coalesce(n.credits, o.credits) AS credits, coalesce(p.organization, '') AS organization, p.licensed FROM o FULL JOIN n USING (date_key, person_id, service_id) LEFT JOIN people p ON p.user_id = person_id""",
)
def credits_fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity and people rows in one table: the last activity of a day, person and service counts, with what is known of the person."""
    people = F.col("event_type") == "signup"
    mixed = table(spark, sf_dir, "events").select(
        F.when(people, "people").otherwise("activity").alias("kind"), "event_id", x.date_key("ts").alias("date_key"), F.col("user_id").alias("person_id"), F.col("event_type").alias("service_id"), F.floor("value").cast("string").alias("credits"),
        F.when(people, F.concat(F.lit("org"), F.col("event_id") % 5)).alias("organization"), F.when(people, F.col("event_id") % 2 == 0).alias("licensed"),
    )
    none = spark.createDataFrame([], "date_key int, person_id long, service_id string, credits double, organization string, licensed boolean")
    part = lambda n: mixed.where((F.col("kind") == "people") | (F.col("event_id") % n == 0))
    return star.load_credits(star.load_credits(none, part(2), "event_id"), part(3), "event_id")


@query(
    "prototype_load",
    _sql(
        ["b_span"],
        """, s AS (SELECT cloud, CASE WHEN span_id % 6 = 0 THEN '(unattributed)' ELSE coalesce(native_agent_id, '(unattributed)') END AS native_agent_id, CASE WHEN span_id % 4 = 0 THEN '(unknown)' ELSE model_key END AS model, date_key, span_id, input_tokens, output_tokens FROM b_span),
        l AS (SELECT cloud, native_agent_id, model, date_key, span_id, 'input_tokens' AS metric, input_tokens AS value FROM s UNION ALL SELECT cloud, native_agent_id, model, date_key, span_id, 'output_tokens', output_tokens FROM s)
        SELECT cloud, native_agent_id, model, date_key, metric, CAST(arg_max(value, span_id) AS DOUBLE) AS value, 1 AS attributed FROM l WHERE value IS NOT NULL GROUP BY 1, 2, 3, 4, 5""",
    ),
)
def prototype_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier loader on spans whose times are days, so that many share a key."""
    spans = bound(spark, sf_dir, "b_span").select(
        "cloud", F.when(F.col("span_id") % 6 != 0, F.col("native_agent_id")).alias("native_agent_id"), F.when(F.col("span_id") % 4 == 0, " ").otherwise(F.col("model_key")).alias("model"),
        F.date_format("ts", "yyyy-MM-dd").alias("ts"), "span_id", "input_tokens", "output_tokens",
    )
    none = spark.createDataFrame([], "cloud string, native_agent_id string, agent_key long")
    agents, rows = star.prototype_load(spans, none, ["input_tokens", "output_tokens"], "span_id")
    return rows.join(agents, "agent_key").select("cloud", "native_agent_id", "model", "date_key", "metric", "value", "attributed")


@query(
    "prototype_snapshot",
    _sql(["b_agent"], " SELECT CASE WHEN event_id % 2 = 0 THEN CAST(-1 AS BIGINT) ELSE CAST(-2 AS BIGINT) END AS agent_key, event_type AS metric, CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INT) AS date_key, CAST(sum(floor(value)) AS BIGINT) AS value_sum, count(*) AS value_count FROM events GROUP BY 1, 2, 3"),
)
def prototype_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics on the sentinels, and the daily snapshot that is rebuilt from them."""
    metrics = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 2 == 0, "aws").otherwise("azure").alias("cloud"), F.col("event_type").alias("metric"), x.date_key("ts").alias("date_key"), F.floor("value").cast("long").alias("value"))
    return facts.snapshot(facts.metric_consumption(metrics, bound(spark, sf_dir, "b_agent")))


@query(
    "tenant_usage_upsert",
    """SELECT date_key, workload, coalesce(n.u, o.u) AS active_users, CASE WHEN n.u IS NOT NULL THEN 'second' ELSE 'first' END AS report_refresh_date FROM
    (SELECT CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INT) AS date_key, event_type AS workload, CAST(count(DISTINCT user_id) AS INT) AS u FROM events GROUP BY 1, 2) o
    FULL JOIN (SELECT CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INT) AS date_key, event_type AS workload, CAST(count(*) AS INT) AS u FROM events WHERE day(ts) > 10 GROUP BY 1, 2) n USING (date_key, workload)""",
)
def tenant_usage_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide reports of users by workload, turned long and merged by day and workload; a later report replaces the numbers."""
    events = table(spark, sf_dir, "events").withColumn("date_key", x.date_key("ts"))
    kinds = sorted(("click", "view", "purchase", "signup", "error"))

    def report(rows: DataFrame, count, refreshed: str) -> DataFrame:
        wide = rows.groupBy("date_key").pivot("event_type", kinds).agg(count.cast("string"))
        return flatten.wide_to_long(wide, ["date_key"], kinds, "workload", "active_users").withColumn("report_refresh_date", F.lit(refreshed))

    first = report(events, F.countDistinct("user_id"), "first")
    return facts.upsert(first, report(events.where(F.dayofmonth("ts") > 10), F.count("event_id"), "second"), ["date_key", "workload"], ["active_users", "report_refresh_date"])


@query(
    "catalogue_snapshots",
    """SELECT d AS capture_date, 'p' || p_partkey AS package_id, CASE WHEN d = 20240131 THEN p_name || '*' ELSE p_name END AS display_name, p_brand AS platform, p_type AS owner_id, p_partkey % 3 = 0 AS is_blocked
    FROM part, (SELECT 20240130 AS d UNION ALL SELECT 20240131) WHERE d = 20240131 OR p_partkey % 2 = 0""",
)
def catalogue_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue of two days; the second day is captured twice, and its last reading counts."""
    part = table(spark, sf_dir, "part")
    items = part.select(F.concat(F.lit("p"), "p_partkey").alias("id"), F.col("p_name").alias("display_name"), F.col("p_brand").alias("platform"), F.col("p_type").alias("owner_id"), F.when(F.col("p_partkey") % 3 == 0, True).alias("is_blocked"), "p_partkey")
    key, kept = ["capture_date", "package_id"], star.catalogue_snapshot(items.where("p_partkey % 2 = 0"), 20240130)
    update = [c for c in kept.columns if c not in key]
    for name in ("display_name", "concat(display_name, '*')"):
        kept = facts.upsert(kept, star.catalogue_snapshot(items.withColumn("display_name", F.expr(name)), 20240131), key, update)
    return kept


@query(
    "dim_runs",
    """WITH r AS (SELECT user_id, CAST(day(ts) AS INT) AS run, arg_min(struct_pack(k := event_type), event_id).k AS kind, arg_min(struct_pack(v := CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS VARCHAR) END), event_id).v AS label FROM events GROUP BY 1, 2)
    SELECT user_id, arg_max(kind, run) AS kind, arg_max(label, run) FILTER (WHERE label IS NOT NULL) AS label FROM r GROUP BY 1""",
)
def dim_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension folded over the days as runs: the first row of a run, the newest value that isn't null."""
    rows = table(spark, sf_dir, "events").select("user_id", F.dayofmonth("ts").alias("run"), "event_id", F.col("event_type").alias("kind"), F.when(F.col("event_id") % 3 == 0, F.col("event_id").cast("string")).alias("label"))
    return star.newest_by_run(rows, ["user_id"], "run", ["event_id"])


@query("dim_keys_stable", "SELECT user_id, CASE WHEN user_id % 2 = 0 THEN dense_rank() OVER (PARTITION BY user_id % 2 ORDER BY user_id) ELSE (SELECT count(DISTINCT user_id) FROM events WHERE user_id % 2 = 0) + dense_rank() OVER (PARTITION BY user_id % 2 ORDER BY user_id) END AS user_key FROM (SELECT DISTINCT user_id FROM events)")
def dim_keys_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers user by user: those numbered first keep theirs, new ones follow."""
    users = table(spark, sf_dir, "events").select("user_id")
    none = users.where("false").select("user_id", F.lit(0).cast("long").alias("user_key"))
    return facts.with_keys(facts.with_keys(none, users.where("user_id % 2 = 0"), ["user_id"], "user_key"), users, ["user_id"], "user_key")


@query(
    "agent_bridges",
    """WITH l AS (SELECT o_orderkey AS agent_key, unnest(['Jira ' || o_orderstatus, 'Mail', o_orderstatus, 'Jira']) AS n, unnest([0, 1, 2, 3]) AS i FROM orders),
    c AS (SELECT agent_key, CASE WHEN n LIKE 'Jira%' THEN 'Jira' ELSE n END AS name, min(i) AS i FROM l GROUP BY 1, 2)
    SELECT agent_key, name AS connector, CAST(row_number() OVER (PARTITION BY agent_key ORDER BY i) - 1 AS INT) AS place FROM c""",
)
def agent_bridges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connectors of agents in the order in which their definition names them, each once, through a numbered dimension."""
    names = F.array(F.concat(F.lit("Jira "), "o_orderstatus"), F.lit("Mail"), F.col("o_orderstatus"), F.lit("Jira"))
    agents = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("agent_key"), F.transform(names, lambda n: x.connector_service(n)).alias("connectors"))
    none = spark.createDataFrame([], "connector string, connector_key long")
    dim = facts.with_keys(none, agents.select(F.explode("connectors").alias("connector")), ["connector"], "connector_key")
    return star.bridge(agents, "agent_key", "connectors", dim, "connector", "connector_key").join(star.few_first(dim), "connector_key").select("agent_key", "connector", "place")


@query("unknown_models", _sql(["b_span"], " SELECT CASE WHEN span_id % 5 = 0 OR span_id % 5 = 1 THEN '(unknown)' ELSE model_key END AS model, count(*) AS spans FROM b_span GROUP BY 1"))
def unknown_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.when(F.col("span_id") % 5 == 0, None).when(F.col("span_id") % 5 == 1, " ").otherwise(F.col("model_key"))
    return bound(spark, sf_dir, "b_span").groupBy(star.or_unknown(named).alias("model")).agg(F.count("*").alias("spans"))


@query(
    "restatement_stamped",
    "SELECT event_id AS id, CASE WHEN day(ts) BETWEEN 5 AND 9 AND event_id % 2 = 0 THEN 'restated' ELSE event_type END AS kind, CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INT) AS d, CASE WHEN day(ts) BETWEEN 5 AND 9 AND event_id % 2 = 0 THEN 'run 2' ELSE 'run 1' END AS ingested_at FROM events WHERE ts < DATE '2024-02-01'",
)
def restatement_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five days before the tenth are restated; rows say which run wrote them."""
    rows = table(spark, sf_dir, "events").where("ts < DATE '2024-02-01'").select(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), x.date_key("ts").alias("d"), F.lit("run 1").alias("ingested_at"))
    return star.restated_at(rows, rows.where("id % 2 = 0").withColumn("kind", F.lit("restated")), ["id"], "d", 20240110, 5, F.lit("run 2"))


# --- rankings and reports --------------------------------------------------------------------------------------------


@query(
    "cost_hierarchy_categories",
    _sql(
        ["b_cost"],
        """ SELECT s AS subscription_id, g AS resource_group, k AS meter_category, meter_name, sum(c) AS cost, CAST(grouping(s, g, k, meter_name) AS BIGINT) AS level FROM
        (SELECT regexp_extract(resource_id, 'subscriptions/([^/]+)', 1) AS s, regexp_extract(resource_id, 'resourceGroups/([^/]+)', 1) AS g, CASE WHEN meter_name < '3' THEN 'high' ELSE 'low' END AS k, meter_name,
                CAST(coalesce(effective_cost, billed_cost, 0) AS DECIMAL(18, 2)) AS c FROM b_cost) GROUP BY ROLLUP (s, g, k, meter_name)""",
    ),
)
def cost_hierarchy_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.cost_hierarchy(bound(spark, sf_dir, "b_cost").withColumn("meter_category", F.when(F.col("meter_name") < "3", "high").otherwise("low")))


@query(
    "top_agents",
    _sql([*SPAN_VIEWS, "b_cost"], SPANS, ALLOCATION, "SELECT agent_key, sum(allocated_cost) AS allocated_cost, CAST(sum(tokens) AS BIGINT) AS tokens FROM allocation WHERE cost_basis = 'allocated' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"),
)
def top_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    spent = allocation_of(spark, sf_dir).where("cost_basis = 'allocated'").groupBy("agent_key").agg(F.sum("allocated_cost").alias("allocated_cost"), F.sum("tokens").alias("tokens"))
    return measures.top(spent, "allocated_cost", "agent_key", 20)


@query(
    "top_clusters",
    _sql([*SPAN_VIEWS, "b_cost", "b_audit"], SPANS, AUDIT, ALLOCATION, CARD, "SELECT config_hash, count(*) AS members, count(*) FILTER (WHERE has_usage_signal) AS used_members FROM card WHERE in_dup_cluster GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
)
def top_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters = scorecard_of(spark, sf_dir).where("in_dup_cluster").groupBy("config_hash").agg(F.count("*").alias("members"), F.count_if("has_usage_signal").alias("used_members"))
    return measures.top(clusters, "members", "config_hash", 10)


@query(
    "usage_by_type",
    _sql(["b_agent", "b_audit"], AUDIT, "SELECT a.agent_type, CAST(sum(1) AS BIGINT) AS events, count(*) AS rows FROM r_audit e LEFT JOIN (SELECT * FROM b_agent WHERE agent_key % 4 <> 1) a ON a.agent_key = e.agent_key GROUP BY 1"),
)
def usage_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by the type of their agent; those of agents that the dimension lacks are in the blank row."""
    events = audit_of(spark, sf_dir).withColumn("events", F.lit(1).cast("long"))
    return star.with_blank(events, bound(spark, sf_dir, "b_agent").where("agent_key % 4 <> 1"), "agent_key", ["agent_type"], "events")


@query(
    "agent_alerts",
    _sql(
        ["b_agent", "b_audit"],
        AUDIT,
        """, u AS (SELECT agent_key, date_key, count(*) AS events, count(*) FILTER (WHERE dlp_evaluation_deferred = 1) AS deferred, date_diff('day', strptime(CAST(date_key AS VARCHAR), '%Y%m%d'), DATE '2024-01-20') AS ago FROM r_audit GROUP BY 1, 2),
        w AS (SELECT agent_key, coalesce(sum(events) FILTER (WHERE ago < 7), 0) AS en, coalesce(sum(events) FILTER (WHERE ago >= 7), 0) AS eb, coalesce(sum(deferred) FILTER (WHERE ago < 7), 0) AS dn, coalesce(sum(deferred) FILTER (WHERE ago >= 7), 0) AS db FROM u WHERE ago BETWEEN 0 AND 13 GROUP BY 1),
        c AS (SELECT a.agent_key, a.owner_id, a.agent_type, l.last_day FROM b_agent a LEFT JOIN (SELECT agent_key, max(date_key) AS last_day FROM r_audit WHERE date_key <= 20240120 GROUP BY 1) l USING (agent_key) WHERE a.agent_key > 0)
        SELECT agent_key, 'idle' AS alert FROM c WHERE last_day IS NULL OR date_diff('day', strptime(CAST(last_day AS VARCHAR), '%Y%m%d'), DATE '2024-01-20') > 2
        UNION ALL SELECT agent_key, 'metadata_gap' FROM c WHERE owner_id IS NULL OR agent_type IS NULL
        UNION ALL SELECT agent_key, 'dlp_rising' FROM c JOIN w USING (agent_key) WHERE dn > db UNION ALL SELECT agent_key, 'use_falling' FROM c JOIN w USING (agent_key) WHERE en < 0.9 * eb""",
    ),
)
def agent_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = audit_of(spark, sf_dir)
    last = audit.where("date_key <= 20240120").groupBy("agent_key").agg(F.max("date_key").alias("last_day"))
    card = bound(spark, sf_dir, "b_agent").where("agent_key > 0").join(last, "agent_key", "left").select("agent_key", "owner_id", "agent_type", "last_day")
    usage = audit.groupBy("agent_key", "date_key").agg(F.count("*").alias("events"), F.count_if(F.col("dlp_evaluation_deferred") == 1).alias("deferred"))
    return star.agent_alerts(card, usage, 20240120, idle_days=2, drop=0.9)


@query(
    "native_unit_rating",
    """SELECT unit, date_key, quantity, CASE WHEN unit = 'view' AND date_key >= 20240110 THEN 3 WHEN unit = 'view' THEN 2 WHEN unit = 'click' AND date_key < 20240120 THEN 5 END AS unit_rate,
    quantity * CASE WHEN unit = 'view' AND date_key >= 20240110 THEN 3 WHEN unit = 'view' THEN 2 WHEN unit = 'click' AND date_key < 20240120 THEN 5 END AS cost
    FROM (SELECT event_type AS unit, CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INT) AS date_key, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS quantity FROM events GROUP BY 1, 2)""",
)
def native_unit_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities at the rates of their days: a rate that changed, one that ended, and units without any."""
    rates = spark.createDataFrame([("view", 0, 20240110, 2), ("view", 20240110, None, 3), ("click", 0, 20240120, 5)], "unit string, valid_from int, valid_to int, unit_rate long")
    usage = table(spark, sf_dir, "events").select(F.col("event_type").alias("unit"), x.date_key("ts").alias("date_key"), F.floor("value").cast("long").alias("quantity"))
    return star.rated(usage, rates, "unit", "date_key", "quantity")


# --- files -------------------------------------------------------------------------------------------------------------


@query("json_page_source", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, count(*) FILTER (WHERE event_id % 1000 = 7) AS single FROM events GROUP BY 1")
def json_page_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that hold a list, and pages of one object."""
    path = folder(spark, "pages")
    events = table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct("event_id", "event_type")).alias("value"), F.expr("event_id div 1000").alias("page"))
    lists = events.where("event_id % 1000 <> 7").groupBy("page").agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value"))
    objects = events.where("event_id % 1000 = 7").select((-1 - F.col("page")).alias("page"), "value")
    lists.unionByName(objects).repartition("page").write.partitionBy("page").text(path)  # a file a page
    rows = landing.json_pages(spark, path).select(F.get_json_object("raw", "$.event_type").alias("event_type"), F.get_json_object("raw", "$.event_id").cast("long").alias("id"))
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("id").alias("ids"), F.count_if(F.col("id") % 1000 == 7).alias("single"))


@query("csv_report", "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS workload, CAST(count(*) AS INT) AS active_users FROM events WHERE event_type IN ('click', 'view') GROUP BY 1, 2")
def csv_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports with a byte-order mark and a header, one a day, wide; read and turned long."""
    path = folder(spark, "reports")
    days = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("d")).pivot("event_type", ["click", "view"]).agg(F.count("event_id"))
    line = F.concat_ws(",", "d", F.coalesce(F.col("click").cast("string"), F.lit(" ")), F.coalesce(F.col("view").cast("string"), F.lit("")))
    days.select("d", F.concat(F.lit("\ufeffReport Date,click,view\n"), line).alias("value")).withColumn("file", F.col("d")).drop("d").repartition("file").write.partitionBy("file").text(path)
    wide = landing.csv_report(spark, path, ["day", "click", "view"]).select("day", "click", "view")
    return flatten.wide_to_long(wide, ["day"], ["click", "view"], "workload", "active_users")


@query("ndjson_consolidated", "SELECT dt, count(*) AS n, CAST(sum(c) AS BIGINT) AS counts FROM (SELECT strftime(ts, '%Y-%m-%d') AS dt, min(event_id) AS c FROM events WHERE event_id % 11 <> 0 AND event_id % 3 <> 2 GROUP BY user_id, strftime(ts, '%Y-%m-%d')) GROUP BY 1")
def ndjson_consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of two chunks, one of which overlaps itself, and of a chunk that isn't there: validated, one row a key, written by event day."""
    parts, target = folder(spark, "parts"), folder(spark, "consolidated")
    # a key's rows are alike, so it doesn't matter which of them comes first
    first = F.min("event_id").alias("activity_count")
    keys = table(spark, sf_dir, "events").where("event_id % 11 <> 0 AND event_id % 3 <> 2").groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("report_date")).agg(first)
    text = F.to_json(F.struct(F.col("user_id").cast("string").alias("user_id"), "report_date", "activity_count"))
    broken = table(spark, sf_dir, "events").where("event_id % 11 = 0").select(F.lit("{}").alias("value"))
    keys.select(text.alias("value")).unionByName(broken).write.text(f"{parts}/chunk=0")
    keys.where("user_id % 2 = 0").select(text.alias("value")).write.text(f"{parts}/chunk=1")
    pages = [landing.ndjson_parts(spark, f"{parts}/chunk={i}") for i in range(3)]
    valid, _, _ = pipelines.run(pages[0].unionByName(pages[1]).unionByName(pages[2]), pipelines.SOURCES["m365_user_activity"])
    landing.write_partitioned(landing.event_day(valid, "report_date").repartition("dt"), target)
    return spark.read.parquet(target).groupBy(F.date_format("dt", "yyyy-MM-dd").alias("dt")).agg(F.count("*").alias("n"), F.sum("activity_count").alias("counts"))


@query("event_day_sink", "SELECT CASE WHEN event_id % 5 = 0 THEN 'unknown' ELSE strftime(ts, '%Y-%m-%d') END AS dt, event_type AS service, count(*) AS n FROM events GROUP BY 1, 2")
def event_day_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day and service, those without a time as unknown; a second write of a service's chunk replaces its own files only."""
    path = folder(spark, "by-day")
    stamp = F.when(F.col("event_id") % 5 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.when(F.col("event_id") % 10 == 0, ""))
    rows = landing.event_day(table(spark, sf_dir, "events").select("event_id", stamp.alias("creation_date"), F.col("event_type").alias("service"))).repartition("dt", "service")
    for part in (rows, rows.where("service = 'click'")):
        landing.write_partitioned(part, path, ["dt", "service"])
    days = spark.read.schema("event_id long, creation_date string, dt string, service string").parquet(path)
    return days.groupBy("dt", "service").agg(F.count("*").alias("n"))


@query("cursor_load", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, 2 AS batches FROM events GROUP BY 1")
def cursor_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs from a batch cursor, which moves only behind a write: each event is loaded once."""
    target, state = folder(spark, "batches"), folder(spark, "cursors")
    stamped = table(spark, sf_dir, "events").select("event_id", "event_type", F.format_string("%012d", "event_id").alias("at"))
    middle = stamped.agg(F.format_string("%012d", F.expr("max(event_id) div 2"))).first()[0]
    for run, seen in enumerate((stamped.where(F.col("at") <= middle), stamped)):
        fresh = landing.since(seen, "at", landing.read_cursor(spark, state, "events"))
        fresh.withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(target)
        top = fresh.agg(F.max("at")).first()[0]
        if top is not None:
            landing.advance_cursor(spark, state, "events", top, run)
    loaded = spark.read.parquet(target)
    batches = loaded.agg(F.countDistinct("run").cast("int").alias("batches"))
    return loaded.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids")).crossJoin(F.broadcast(batches))  # one row


@query("full_rebuild", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1")
def full_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rebuild reads files that the load log has as well."""
    path = folder(spark, "rebuilt")
    table(spark, sf_dir, "events").select("event_id", "event_type").write.parquet(path)
    scanned = landing.scan(spark, path)
    rows = landing.new_files(scanned, scanned.select(F.col("_file").alias("file_path")).distinct(), full_scan=True)
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("hour_partitions", "SELECT strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hour, count(*) AS n FROM events GROUP BY 1, 2")
def hour_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day and hour; two hours are written twice and not doubled."""
    path = folder(spark, "hours")
    events = table(spark, sf_dir, "events").select("event_id", "ts").repartition(F.to_date("ts"))
    for part in (events, events.where("hour(ts) < 2")):
        landing.write_by_hour(part, path, "ts")
    return spark.read.schema("event_id long, dt string, hour string").parquet(path).groupBy("dt", "hour").agg(F.count("*").alias("n"))


# --- scalar helpers ------------------------------------------------------------------------------------------------------


@query(
    "scalar_values",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_id WHEN 1 THEN CAST(floor(value) AS BIGINT) END AS safe_long, CASE event_id % 4 WHEN 0 THEN CAST(event_id AS DOUBLE) WHEN 1 THEN value END AS safe_double,
    CASE event_id % 3 WHEN 0 THEN event_type END AS drift_k, CASE event_id % 3 WHEN 0 THEN 'first' END AS first_item,
    CASE event_id % 3 WHEN 0 THEN strftime(make_timestamp(CAST(1700000000 + event_id AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN 'as it is' END AS dotnet,
    strftime(make_timestamp(CAST(1700000000 + event_id AS BIGINT) * 1000000 + 5), '%Y-%m-%dT%H:%M:%S.%fZ') AS nanos, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso,
    CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS utc, CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 3 = 1 THEN 30 ELSE 5 END AS scan_days FROM events""",
)
def scalar_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of text, drift, lists, times and scan windows, event by event."""
    case = lambda n, *values: F.expr(f"CASE event_id % {n} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END")
    number = case(4, "string(event_id)", "string(value)", "'many'")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    end = F.expr("DATE '2024-02-01'")
    cursor = case(3, "DATE '2024-02-09'", "CAST(NULL AS DATE)", "DATE '2024-01-27'")
    return table(spark, sf_dir, "events").select(
        "event_id", x.safe_long(number).alias("safe_long"), x.safe_double(number).alias("safe_double"),
        F.try_variant_get(x.drift_object(case(3, "to_json(named_struct('k', event_type))", "'[1]'", "'{bad'")), "$.k", "string").alias("drift_k"), x.first_of_list(case(3, "'[\"first\", \"second\"]'", "'[]'", "'bad'")).alias("first_item"),
        x.dotnet_date(case(3, "concat('/Date(', (1700000000 + event_id) * 1000, ')/')", "'as it is'", "'/Date(99999999999999999)/'")).alias("dotnet"), x.nanos_iso(F.expr("string((1700000000 + event_id) * 1000000000 + 5678)")).alias("nanos"),
        F.replace(x.iso_stamp("ts"), F.lit("+00:00"), F.lit("Z")).alias("iso"), F.unix_timestamp(x.utc_stamp(F.when(F.col("event_id") % 2 == 0, stamp).otherwise(F.concat(stamp, F.lit("Z"))))).alias("utc"),
        F.datediff(end, x.scan_start(cursor, end, 30)).alias("scan_days"),
    )


@query(
    "flatten_agent_attributes",
    """SELECT 'p' || p_partkey AS native_agent_id, p_brand AS agent_type, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_type END AS description, CASE p_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 END AS enabled, p_type AS owner_id,
    unnest(['Jira', p_brand]) AS connector FROM part""",
)
def flatten_agent_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue entries with their attributes (the short description where there is no long one, enabled if said not to be blocked) and connectors by service."""
    text = """named_struct('value', array(named_struct('id', concat('p', p_partkey), 'displayName', p_name, 'platform', p_brand, 'ownerId', p_type, 'isBlocked', if(p_partkey % 4 = 0, true, if(p_partkey % 4 = 1, false, NULL)),
        'longDescription', if(p_partkey % 3 = 0, p_name, ' '), 'shortDescription', p_type, 'elementDetails', array(named_struct('elements', array(named_struct('definition', to_json(named_struct(
            'Tools', array(named_struct('name', 'Jira issues', 'metadata', named_struct('tool_type', 'api_action')), named_struct('name', p_brand, 'metadata', named_struct('tool_type', 'api_action')), named_struct('name', 'Jira', 'metadata', named_struct('tool_type', 'api_action'))))))))))))"""
    found = flatten.agent_details(table(spark, sf_dir, "part").select(F.to_json(F.expr(text)).alias("raw")))
    return found.select("native_agent_id", "agent_type", "description", "enabled", "owner_id", F.explode("connectors").alias("connector"))

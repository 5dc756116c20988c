"""Registered queries of flattening, sources, sinks and incremental loads, over payloads made of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.functions import expressions as x
from fleetspark.operators import facts, flatten, quality
from fleetspark.plans.catalog import table
from fleetspark.plans.registry import query
from fleetspark.sources import landing, pipelines
from fleetspark.sources.scratch import folder
from fleetspark.streaming.incremental import load_new


def _json(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """Rows as JSON texts, from SQL for a struct."""
    return df.select(F.to_json(F.expr(text)).alias("raw"), *keep)


@query("flatten_cost_buckets", "SELECT strftime(o_orderdate, '%Y-%m-%d') AS time_period_start, o_orderpriority AS usage_type, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS operation, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_totalprice END AS unblended_cost, CAST(o_custkey AS DOUBLE) AS usage_quantity FROM orders")
def flatten_cost_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """named_struct('TimePeriod', named_struct('Start', date_format(o_orderdate, 'yyyy-MM-dd')), 'Groups', array(named_struct(
        'Keys', if(o_orderkey % 4 = 0, array(o_orderpriority), array(o_orderpriority, o_orderstatus)),
        'Metrics', named_struct('UnblendedCost', if(o_orderkey % 3 = 0, NULL, named_struct('Amount', string(o_totalprice))), 'UsageQuantity', named_struct('Amount', string(o_custkey))))))"""
    return flatten.cost_buckets(_json(table(spark, sf_dir, "orders"), text))


@query("flatten_log_envelope", "SELECT CASE WHEN event_id % 5 = 0 THEN 'e' || event_id ELSE 'r' || event_id END AS request_id, CASE WHEN event_id % 5 <> 0 THEN event_type END AS model_id, CASE WHEN event_id % 5 <> 0 THEN CAST(floor(value) AS BIGINT) END AS input_token_count FROM events")
def flatten_log_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """named_struct('eventId', concat('e', event_id), 'message', if(event_id % 5 = 0, 'not json {', to_json(named_struct(
        'requestId', concat('r', event_id), 'modelId', event_type, 'input', named_struct('inputTokenCount', bigint(floor(value)))))))"""
    return flatten.log_envelope(_json(table(spark, sf_dir, "events"), text)).select("request_id", "model_id", "input_token_count")


@query("flatten_metric_arrays", "SELECT 'm' || CAST(event_id % 3 AS VARCHAR) AS metric_name, 't' || CAST(i AS VARCHAR) AS timestamp, value + i AS value, CASE WHEN event_id % 3 = 1 THEN 'Average' ELSE 'Sum' END AS stat FROM (SELECT event_id, value, unnest(range(event_id % 4)) AS i FROM events WHERE event_id % 3 <> 1) UNION ALL SELECT 'InvocationLatency', 't' || CAST(i AS VARCHAR), value + i, 'Average' FROM (SELECT event_id, value, unnest(range(event_id % 4)) AS i FROM events WHERE event_id % 3 = 1)")
def flatten_metric_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values run longer than times; the shorter counts."""
    text = """named_struct('Id', string(event_id % 3), 'Timestamps', transform(filter(sequence(0, 3), i -> i < event_id % 4), i -> concat('t', i)), 'Values', transform(sequence(0, 4), i -> value + i))"""
    identity = spark.createDataFrame([("0", "m0"), ("1", "InvocationLatency"), ("2", "m2")], "id string, metric_name string")
    return flatten.metric_arrays(_json(table(spark, sf_dir, "events"), text), identity).select("metric_name", "timestamp", "value", "stat")


@query(
    "flatten_spans",
    """SELECT 's' || event_id AS span_id, 't' || CAST(event_id // 5 AS VARCHAR) AS trace_id, event_type AS operation_name, CASE WHEN event_id % 2 = 0 THEN 'svc' || user_id END AS service_name,
    CASE WHEN event_id % 2 = 0 THEN 'r1' END AS cloud_region, CASE event_id % 4 WHEN 0 THEN CAST(floor(value) AS BIGINT) WHEN 1 THEN CAST(floor(value) AS BIGINT) + 1 WHEN 2 THEN CAST(floor(value) AS BIGINT) + 7 END AS token_count,
    CASE event_id % 3 WHEN 0 THEN 'a' || user_id WHEN 1 THEN 'n' || user_id ELSE CASE WHEN event_id % 2 = 0 THEN 'svc' || user_id END END AS gen_ai_agent_id,
    CASE event_id % 5 WHEN 0 THEN 's0' WHEN 1 THEN 's1' WHEN 2 THEN 's2' END AS session_id,
    CASE event_type WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'boom' END WHEN 'purchase' THEN 'ERROR' WHEN 'signup' THEN 'HTTP 500' WHEN 'click' THEN 'HTTP 503' WHEN 'view' THEN 'E' END AS error_type FROM events WHERE event_id % 10 <> 9""",
)
def flatten_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling and alias of ids, agents, sessions, tokens and errors; a status that only looks like an error isn't one."""
    said = {
        "gen_ai.usage.total_tokens": "if(event_id % 4 = 0, string(bigint(floor(value))), NULL)", "llm.usage.total_tokens": "if(event_id % 4 = 1, string(bigint(floor(value)) + 1), NULL)",
        "gen_ai.usage.input_tokens": "if(event_id % 4 = 2, string(bigint(floor(value))), NULL)", "gen_ai.usage.completion_tokens": "if(event_id % 4 = 2, '7', NULL)",
        "gen_ai.agent.id": "if(event_id % 3 = 0, concat('a', user_id), if(event_id % 3 = 1, '', NULL))", "gen_ai.agent.name": "if(event_id % 3 = 1, concat('n', user_id), NULL)",
        "session.id": "if(event_id % 5 = 0, 's0', NULL)", "gen_ai.conversation.id": "if(event_id % 5 < 2, 's1', NULL)", "aws.bedrock.agentcore.session.id": "if(event_id % 5 < 3, 's2', NULL)",
        "http.response.status_code": "if(event_type = 'signup', '500', NULL)", "http.status_code": "if(event_type = 'click', '503', NULL)", "exception.type": "if(event_type = 'view', 'E', NULL)",
    }
    attributes = f"map_filter(map({', '.join(f'{k!r}, {v}' for k, v in said.items())}), (k, v) -> v IS NOT NULL)"
    text = f"""named_struct('spanId', if(event_id % 10 >= 8, NULL, concat('s', event_id)), 'span_id', if(event_id % 10 = 8, concat('s', event_id), NULL), 'traceId', if(event_id % 10 = 8, NULL, concat('t', event_id div 5)),
        'trace_id', if(event_id % 10 = 8, concat('t', event_id div 5), NULL), 'name', event_type,
        'status', CASE event_type WHEN 'error' THEN named_struct('code', if(event_id % 2 = 0, 'STATUS_CODE_ERROR', 'STATUS_ERROR'), 'message', 'boom') WHEN 'purchase' THEN named_struct('code', 'error', 'message', '') END,
        'attributes', {attributes}, 'resource', if(event_id % 2 = 0, map('service.name', concat('svc', user_id), 'cloud.region', 'r1'), NULL))"""
    found = flatten.otel_spans(_json(table(spark, sf_dir, "events"), text))
    return found.select("span_id", "trace_id", "operation_name", "service_name", "cloud_region", "token_count", "gen_ai_agent_id", "session_id", "error_type")


@query("flatten_cost_rows", "SELECT '/subscriptions/s' || CAST(o_custkey % 9 AS VARCHAR) || '/resourceGroups/g' || CAST(o_custkey % 5 AS VARCHAR) AS resource_id, strftime(o_orderdate, '%Y-%m-%d') AS charge_period_start, o_totalprice AS billed_cost, 's' || CAST(o_custkey % 9 AS VARCHAR) AS subscription_id, 'g' || CAST(o_custkey % 5 AS VARCHAR) AS resource_group FROM orders WHERE o_orderkey % 6 <> 0")
def flatten_cost_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """named_struct('columns', array(named_struct('name', 'Cost'), named_struct('name', 'UsageDate'), named_struct('name', 'ResourceId'), named_struct('name', 'Currency')),
        'rows', array(array(string(o_totalprice), date_format(o_orderdate, 'yyyyMMdd'), if(o_orderkey % 6 = 0, NULL, concat('/subscriptions/s', o_custkey % 9, '/resourceGroups/g', o_custkey % 5)))))"""
    return flatten.cost_rows(_json(table(spark, sf_dir, "orders"), text)).select("resource_id", "charge_period_start", "billed_cost", "subscription_id", "resource_group")


@query("flatten_metric_series", "SELECT event_type AS metric_name, 't' || event_id AS timestamp, CASE WHEN event_id % 3 = 0 THEN value ELSE value * 2 END AS value, 'd' || user_id AS model_deployment_name FROM events WHERE event_id % 3 <> 2")
def flatten_metric_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """named_struct('name', named_struct('value', event_type), 'timeseries', array(named_struct(
        'metadatavalues', array(named_struct('name', named_struct('value', 'ModelDeploymentName'), 'value', concat('d', user_id))),
        'data', array(named_struct('timeStamp', concat('t', event_id), 'total', if(event_id % 3 = 0, value, NULL), 'average', if(event_id % 3 = 1, value * 2, NULL))))))"""
    return flatten.metric_series(_json(table(spark, sf_dir, "events"), text)).select("metric_name", "timestamp", "value", "model_deployment_name")


@query("flatten_audit", "SELECT 'a' || event_id AS record_id, event_type AS operation, CASE WHEN event_type = 'view' THEN 'Copilot' ELSE 'Exchange' END AS workload, CASE event_id % 6 WHEN 0 THEN 'app' WHEN 3 THEN 'agent' END AS app_identity, CASE event_id % 3 WHEN 0 THEN 'inner' WHEN 1 THEN 'channel' END AS app_host FROM events WHERE event_id % 7 <> 0 AND (event_id % 3 <> 2 OR event_type = 'view')")
def flatten_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without an id or out of scope go; identity and host come from the interaction data, whatever the event itself says."""
    text = """named_struct('Id', if(event_id % 7 = 0, if(event_id % 2 = 0, '', NULL), concat('a', event_id)), 'Operation', event_type, 'Workload', if(event_type = 'view', 'Copilot', 'Exchange'), 'AppHost', 'outer', 'AppIdentity', 'outer',
        'CopilotEventData', if(event_id % 3 = 2, NULL, named_struct('ThreadId', 'x', 'AppHost', if(event_id % 3 = 0, 'inner', ''), 'ChannelName', 'channel',
            'AppIdentity', if(event_id % 6 = 0, 'app', if(event_id % 6 = 3, '', NULL)), 'TargetPlatformAgentId', if(event_id % 3 = 0, 'agent', NULL))))"""
    return flatten.audit_events(_json(table(spark, sf_dir, "events"), text)).select("record_id", "operation", "workload", "app_identity", "app_host")


@query("flatten_agents", "SELECT 'p' || CAST(p_partkey AS VARCHAR) AS native_agent_id, p_name AS agent_name, CASE WHEN p_partkey % 3 <> 2 THEN p_type END AS instructions, CASE WHEN p_partkey % 3 <> 2 THEN substr(sha256(p_type), 1, 16) END AS config_hash, p_brand AS skill FROM part")
def flatten_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue entries in both envelopes and dialects."""
    text = """named_struct('value', array(named_struct('id', concat('p', p_partkey), 'displayName', p_name, 'elementDetails', array(named_struct('elements', array(
        named_struct('definition', '{bad'), named_struct('definition', CASE p_partkey % 3
            WHEN 0 THEN to_json(named_struct('instructions', p_type, 'capabilities', array(named_struct('name', p_brand))))
            WHEN 1 THEN to_json(named_struct('Instructions', p_type, 'Tools', array(named_struct('name', 'n', 'metadata', named_struct('tool_type', 'capability', 'capability_type', p_brand)))))
            ELSE to_json(named_struct('capabilities', array(p_brand))) END)))))))"""
    found = flatten.agent_details(_json(table(spark, sf_dir, "part"), text))
    return found.select("native_agent_id", "agent_name", "instructions", "config_hash", F.explode_outer("skills").alias("skill"))


# --- sources, sinks and incremental loads ---------------------------------------------------------------------------


def _usage_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """named_struct('package_id', if(event_id % 11 = 0, NULL, concat('p', user_id)), 'report_date', date_format(ts, 'yyyy-MM-dd'), 'active_users', if(event_id % 13 = 0, 'many', string(event_id)), 'extra', if(event_id % 2 = 0, 'x', NULL))"""
    return _json(table(spark, sf_dir, "events"), text, "event_id").select("raw", F.lit("f").alias("_file"), F.col("event_id").alias("_row"))


@query("source_usage", "SELECT package_id, report_date, active_users, CASE WHEN active_users % 2 = 0 THEN '{\"extra\":\"x\"}' END AS _drift FROM (SELECT 'p' || user_id AS package_id, strftime(ts, '%Y-%m-%d') AS report_date, min(event_id) AS active_users FROM events WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 GROUP BY 1, 2)")
def source_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source's job: valid rows, the first of each key."""
    valid, _, _ = pipelines.run(_usage_pages(spark, sf_dir), pipelines.SOURCES["m365_usage"])
    return valid.select("package_id", "report_date", "active_users", "_drift")


@query("source_stats", "SELECT count(DISTINCT (user_id, CAST(ts AS DATE))) FILTER (WHERE ok) AS kept, count(*) FILTER (WHERE ok) - count(DISTINCT (user_id, CAST(ts AS DATE))) FILTER (WHERE ok) AS duplicates, count(*) FILTER (WHERE NOT ok) AS invalid, count(*) FILTER (WHERE ok AND event_id % 2 = 0) AS drifted FROM (SELECT *, event_id % 11 <> 0 AND event_id % 13 <> 0 AS ok FROM events)")
def source_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.run(_usage_pages(spark, sf_dir), pipelines.SOURCES["m365_usage"])[2]


@query("quarantine_sink", "SELECT CASE WHEN event_id % 11 = 0 AND event_id % 13 = 0 THEN 'package_id: required; active_users: not bigint' WHEN event_id % 11 = 0 THEN 'package_id: required' ELSE 'active_users: not bigint' END AS error, count(*) AS n FROM events WHERE event_id % 11 = 0 OR event_id % 13 = 0 GROUP BY 1")
def quarantine_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "quarantine")
    landing.write_quarantine(pipelines.run(_usage_pages(spark, sf_dir), pipelines.SOURCES["m365_usage"])[1], path, "2024-01-31")
    return spark.read.schema("error string, raw string, dt string").json(path).groupBy("error").agg(F.count("*").alias("n"))


@query("raw_sink", "SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1")
def raw_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days are written as partitions, and one of them twice: it is replaced, not doubled."""
    path, rows = folder(spark, "raw"), landing.event_day(table(spark, sf_dir, "events").withColumn("creation_date", F.date_format("ts", "yyyy-MM-dd HH:mm")))
    rows = rows.repartition("dt")
    landing.write_partitioned(rows, path)
    landing.write_partitioned(rows.where("dt = '2024-01-02'"), path)
    return spark.read.parquet(path).groupBy(F.date_format("dt", "yyyy-MM-dd").alias("dt")).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("incremental_load", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1")
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of a file stream with one checkpoint: the second takes only the files that came between."""
    source, target, log = folder(spark, "landing"), folder(spark, "loaded"), folder(spark, "log")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")

    def load(batch: DataFrame, number: int) -> None:
        batch.drop("_file").withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)

    for half in ("event_id % 2 = 0", "event_id % 2 = 1"):
        events.where(half).write.mode("append").parquet(source)
        load_new(spark, source, events.schema, log, load)
    return spark.read.parquet(target).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("load_log_scan", "SELECT event_id FROM events WHERE event_id % 4 = 3")
def load_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in the load log are skipped."""
    path = folder(spark, "files")
    events = table(spark, sf_dir, "events").select("event_id")
    events.where("event_id % 4 <> 3").write.parquet(path)
    seen = landing.scan(spark, path).select(F.col("_file").alias("file_path")).distinct()
    log = folder(spark, "seen")
    seen.write.parquet(log)
    events.where("event_id % 4 = 3").write.mode("append").parquet(path)
    return landing.new_files(landing.scan(spark, path), spark.read.parquet(log)).select("event_id")


@query("versioned_upsert", "SELECT CAST(o_orderkey AS BIGINT) AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE o_orderstatus END AS status, o_custkey AS first_seen FROM orders")
def versioned_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in versions, with a batch merged into it twice: the result is the same."""
    orders = table(spark, sf_dir, "orders")
    kept = landing.Table(spark, folder(spark, "table"))
    kept.replace(orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("first_seen")))
    batch = orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id"), F.lit("new").alias("status"), F.lit(-1).cast("long").alias("first_seen"))
    for _ in range(2):
        kept.replace(facts.upsert(kept.read(), batch, ["id"], ["status"]))
    return kept.read()


@query("active_files", "SELECT 'f' || CAST(k AS VARCHAR) AS path FROM (SELECT user_id AS k, arg_max(event_type <> 'error', event_id) AS live FROM events GROUP BY 1) WHERE live")
def active_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adds and removes replayed: the last action on a file decides."""
    name = F.concat(F.lit("f"), F.col("user_id"))
    removed = F.col("event_type") == "error"
    actions = table(spark, sf_dir, "events").select(F.col("event_id").alias("version"), F.when(~removed, name).alias("add"), F.when(removed, name).alias("remove"))
    return landing.active_files(actions)


@query("scalar_text", "SELECT c_custkey, substr(sha256(trim(c_name)), 1, 16) AS hash, split_part(c_name, '#', 1) AS head, CASE WHEN c_custkey % 2 = 0 THEN '2024-01-0' || CAST(c_custkey % 9 + 1 AS VARCHAR) ELSE NULL END AS iso, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'x' END AS cleaned FROM customer")
def scalar_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text, hash, date and JSON helpers."""
    customers = table(spark, sf_dir, "customer")
    padded = F.concat(F.lit(" \t"), F.col("c_name"), F.lit(" "))
    return customers.select(
        "c_custkey", x.hash16(padded).alias("hash"), F.split_part(x.text(padded), F.lit("#"), F.lit(1)).alias("head"),
        x.iso_day(F.when(F.col("c_custkey") % 2 == 0, 20240101 + F.col("c_custkey") % 9)).alias("iso"), x.json_or_null(F.when(F.col("c_custkey") % 3 == 0, "[]").otherwise("x")).alias("cleaned"),
    )


@query("error_reasons", "SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('view') GROUP BY 1")
def error_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantine reasons by kind."""
    rows = table(spark, sf_dir, "events").withColumn("_errors", quality.errors(table(spark, sf_dir, "events"), ["event_id"], None, {"event_type": ["view"]}))
    return rows.where(F.size("_errors") > 0).groupBy("event_type").agg(F.count("*").alias("n"))

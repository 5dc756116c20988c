"""Registered queries of the raw sources: nested payloads made of the driver's events, run to valid rows.

Each payload is there twice (``event_id div 2`` names it, the first stays); every seventeenth is broken text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.plans.catalog import table
from fleetspark.plans.registry import query
from fleetspark.sources import pipelines


def _pages(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    raw = F.when(F.expr("event_id % 17 = 0"), F.lit("{bad")).otherwise(F.to_json(F.expr(text)))
    return table(spark, sf_dir, "events").select(raw.alias("raw"), F.lit("f").alias("_file"), F.col("event_id").alias("_row"))


def _valid(spark: SparkSession, sf_dir: str, name: str, text: str, *context: DataFrame) -> DataFrame:
    return pipelines.run(_pages(spark, sf_dir, text), pipelines.SOURCES[name], *context)[0]


def _first(columns: str, where: str = "true") -> str:
    """SQL for ``columns`` of the first event of each two that is not broken."""
    return f"SELECT {columns} FROM (SELECT *, event_id // 2 AS h FROM events WHERE event_id % 17 <> 0 AND {where} QUALIFY row_number() OVER (PARTITION BY event_id // 2 ORDER BY event_id) = 1)"


@query("source_bedrock_cost", _first("'d' || h AS time_period_start, unnest(['u1', 'u2']) AS usage_type, event_type AS operation, unnest([value, 0]) AS unblended_cost").replace("event_type AS operation", "'o' AS operation"))
def source_bedrock_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = "named_struct('Keys', array('{u}', 'o'), 'Metrics', named_struct('UnblendedCost', named_struct('Amount', {v})))"
    text = f"named_struct('TimePeriod', named_struct('Start', concat('d', event_id div 2)), 'Groups', array({group.format(u='u1', v='string(value)')}, {group.format(u='u2', v='string(NULL)')}))"
    return _valid(spark, sf_dir, "bedrock_cost", text).select("time_period_start", "usage_type", "operation", "unblended_cost")


@query("source_bedrock_invocations", _first("'r' || h AS request_id, 't' AS timestamp, event_type AS model_id, 'arn' || user_id AS identity_arn, event_id AS input_token_count"))
def source_bedrock_invocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = "named_struct('requestId', concat('r', event_id div 2), 'timestamp', 't', 'modelId', event_type, 'identity', named_struct('arn', concat('arn', user_id)), 'input', named_struct('inputTokenCount', event_id))"
    return _valid(spark, sf_dir, "bedrock_invocations", f"named_struct('eventId', string(event_id), 'message', to_json({message}))").select("request_id", "timestamp", "model_id", "identity_arn", "input_token_count")


@query("source_bedrock_metrics", _first("'Invocations' AS metric_name, 'm' AS model_id, unnest(['a' || h, 'b' || h]) AS timestamp, unnest([value, value + 1]) AS value"))
def source_bedrock_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    identity = spark.createDataFrame([("q", "Invocations", "m")], "id string, metric_name string, model_id string")
    text = "named_struct('Id', 'q', 'Timestamps', array(concat('a', event_id div 2), concat('b', event_id div 2)), 'Values', array(value, value + 1, value + 2))"
    return _valid(spark, sf_dir, "bedrock_metrics", text, identity).select("metric_name", "model_id", "timestamp", "value")


@query("source_bedrock_traces", _first("'s' || h AS span_id, 't' || h AS trace_id, CASE WHEN event_id % 3 = 0 THEN 'a' || user_id ELSE 'svc' END AS gen_ai_agent_id, 'c' || user_id AS session_id, event_id + 7 AS token_count, CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'boom' WHEN event_type = 'view' THEN 'HTTP 503' END AS error_type, 'r1' AS region", "event_id % 5 <> 0"))
def source_bedrock_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """named_struct('spanId', if(event_id % 5 = 0 OR event_id % 5 = 1, NULL, concat('s', event_id div 2)), 'span_id', if(event_id % 5 = 1, concat('s', event_id div 2), NULL), 'trace_id', concat('t', event_id div 2), 'startTimeUnixNano', '1700000000000000000',
        'status', if(event_type = 'error', named_struct('code', if(event_id % 2 = 0, 'STATUS_CODE_ERROR', 'STATUS_ERROR'), 'message', 'boom'), NULL),
        'attributes', map_filter(map('gen_ai.agent.name', if(event_id % 3 = 0, concat('a', user_id), NULL), 'gen_ai.conversation.id', concat('c', user_id), 'gen_ai.usage.input_tokens', string(event_id), 'gen_ai.usage.output_tokens', '7',
            'http.status_code', if(event_type = 'view', '503', NULL)), (k, v) -> v IS NOT NULL),
        'resource', named_struct('attributes', map('service.name', 'svc', 'cloud.region', 'r1')))"""
    return _valid(spark, sf_dir, "bedrock_traces", text).select("span_id", "trace_id", "gen_ai_agent_id", "session_id", "token_count", "error_type", F.get_json_object("_drift", "$.cloud_region").alias("region"))


@query("source_foundry_cost", _first("'/subscriptions/s/resourceGroups/g/r' || h AS resource_id, '2024-01-31' AS charge_period_start, 'm' AS meter_name, value AS billed_cost, 's' AS subscription_id, 'g' AS resource_group", "event_id % 5 <> 0"))
def source_foundry_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = "transform(array('ResourceId', 'UsageDate', 'Meter', 'Cost'), n -> named_struct('name', n))"
    row = "array(if(event_id % 5 = 0, NULL, concat('/subscriptions/s/resourceGroups/g/r', event_id div 2)), '20240131', 'm', string(value))"
    found = _valid(spark, sf_dir, "foundry_cost", f"named_struct('columns', {names}, 'rows', array({row}))")
    return found.select("resource_id", "charge_period_start", "meter_name", "billed_cost", "subscription_id", "resource_group")


@query("source_foundry_metrics", _first("'Requests' AS metric_name, 't' || h AS timestamp, unnest(['d1', 'd2']) AS model_deployment_name, unnest([value, value + 1]) AS value"))
def source_foundry_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = "named_struct('metadatavalues', array(named_struct('name', named_struct('value', 'ModelDeploymentName'), 'value', '{d}')), 'data', array(named_struct('timeStamp', concat('t', event_id div 2), 'average', {v}), named_struct('timeStamp', 'gap', 'average', double(NULL))))"
    text = f"named_struct('name', named_struct('value', 'Requests'), 'timeseries', array({series.format(d='d1', v='value')}, {series.format(d='d2', v='value + 1')}))"
    return _valid(spark, sf_dir, "foundry_metrics", text).select("metric_name", "timestamp", "model_deployment_name", "value")


@query("source_foundry_traces", _first("'s' || h AS span_id, 'u' || user_id AS caller_id, CASE WHEN event_type <> 'view' THEN 'a' || user_id END AS gen_ai_agent_id, 'invoke_agent' AS span_kind, 'gpt' AS model_name, event_id AS prompt_tokens, event_id + 7 AS total_tokens", "event_type <> 'click'"))
def source_foundry_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks are outside of the gen_ai scope; views name no agent, the first alias of a caller is empty."""
    bag = """named_struct('gen_ai.operation.name', if(event_type = 'click', 'chat', 'invoke_agent'), 'gen_ai.agent.id', if(event_type IN ('click', 'view'), '', concat('a', user_id)), 'user.id', '', 'enduser.id', concat('u', user_id),
        'gen_ai.request.model', 'gpt', 'gen_ai.usage.prompt_tokens', event_id, 'gen_ai.usage.output_tokens', '7')"""
    names = "transform(array('Id', 'TimeGenerated', 'Properties'), n -> named_struct('name', n))"
    text = f"named_struct('tables', array(named_struct('columns', {names}, 'rows', array(array(concat('s', event_id div 2), 't', to_json({bag}))))))"
    return _valid(spark, sf_dir, "foundry_traces", text).select("span_id", "caller_id", "gen_ai_agent_id", "span_kind", "model_name", "prompt_tokens", "total_tokens")


@query("source_m365_registry", _first("'p' || h AS package_id, 'sharepoint' AS agent_type, event_type AS name, '[\"x\"]' AS connectors"))
def source_m365_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "named_struct('package_id', concat('p', event_id div 2), 'agent_type', 'sharepoint', 'name', event_type, 'connectors', array('x'))"
    return _valid(spark, sf_dir, "m365_registry", text).select("package_id", "agent_type", "name", "connectors")


@query("source_m365_user_activity", _first("'u' || h AS user_id, '2024-01-31' AS report_date, event_type AS product, event_id AS activity_count"))
def source_m365_user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "named_struct('user_id', concat('u', event_id div 2), 'report_date', '2024-01-31', 'product', event_type, 'activity_count', event_id)"
    return _valid(spark, sf_dir, "m365_user_activity", text).select("user_id", "report_date", "product", "activity_count")


@query("source_purview_audit", _first("'a' || h AS record_id, event_type AS operation, CASE WHEN event_id % 3 = 0 THEN 'inner' ELSE 'target' END AS app_identity", "event_type <> 'click' AND event_id % 7 <> 0"))
def source_purview_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks are out of scope, and so is an event without an id."""
    text = """named_struct('Id', if(event_id % 7 = 0, NULL, concat('a', event_id div 2)), 'CreationTime', 't', 'Operation', event_type, 'Workload', 'Exchange', 'AppIdentity', 'outer',
        'CopilotEventData', if(event_type = 'click', NULL, named_struct('AppIdentity', if(event_id % 3 = 0, 'inner', NULL), 'TargetPlatformAgentId', 'target')))"""
    return _valid(spark, sf_dir, "purview_audit", text).select("record_id", "operation", "app_identity")


@query("source_audit_rejects", "SELECT count(*) FILTER (WHERE event_id % 17 <> 0 AND event_id % 7 <> 0) AS valid, count(*) FILTER (WHERE event_id % 17 = 0) AS rejected FROM events")
def source_audit_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event without an id is dropped, not quarantined; broken text is quarantined."""
    text = "named_struct('Id', if(event_id % 7 = 0, NULL, concat('a', event_id)), 'CreationTime', 't', 'Workload', 'AI')"
    valid, rejected, _ = pipelines.run(_pages(spark, sf_dir, text), pipelines.SOURCES["purview_audit"])
    return valid.agg(F.count("*").alias("valid")).crossJoin(rejected.agg(F.count("*").alias("rejected")))  # one row each


@query(
    "source_audit_graph",
    """SELECT CASE WHEN event_id % 4 = 2 THEN 'own' || event_id ELSE 'g' || event_id END AS record_id, 't' || event_id AS creation_date, CASE event_id % 4 WHEN 1 THEN NULL WHEN 2 THEN 'inner' ELSE event_type END AS operation,
    CASE WHEN event_id % 4 = 2 THEN NULL WHEN event_id % 3 = 0 THEN 'u' || user_id ELSE 'id' || user_id END AS user_id, CASE WHEN event_id % 4 = 1 THEN NULL WHEN event_type = 'view' THEN 'Copilot' ELSE 'Exchange' END AS workload,
    CASE event_id % 4 WHEN 1 THEN 'a' || user_id WHEN 2 THEN 'b' || user_id END AS app_identity
    FROM events WHERE event_id % 17 <> 0 AND (event_id % 4 IN (1, 2) OR event_type = 'view')""",
)
def source_audit_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graph records whose audit data lacks a key, has it as null, or has it; or that have no audit data."""
    data = """CASE event_id % 4 WHEN 0 THEN parse_json('{}') WHEN 1 THEN parse_json(concat('{"Operation":null,"Workload":null,"CopilotEventData":{"AppIdentity":"a', user_id, '"}}'))
        WHEN 2 THEN parse_json(concat('{"Id":"own', event_id, '","Operation":"inner","UserId":null,"CopilotEventData":{"AppIdentity":"","TargetPlatformAgentId":"b', user_id, '"}}')) END"""
    text = f"""named_struct('id', concat('g', event_id), 'createdDateTime', concat('t', event_id), 'operation', event_type, 'userPrincipalName', if(event_id % 3 = 0, concat('u', user_id), ''), 'userId', concat('id', user_id),
        'service', if(event_type = 'view', 'Copilot', 'Exchange'), 'auditData', {data})"""
    return pipelines.run(_pages(spark, sf_dir, text), pipelines.AUDIT_GRAPH)[0].select("record_id", "creation_date", "operation", "user_id", "workload", "app_identity")


@query("source_purview_audit_drift", _first("'a' || h AS record_id, 'ip' || user_id AS client, CASE WHEN event_type = 'view' THEN NULL ELSE '{\"AppIdentity\":\"inner\",\"AppHost\":\"host\"}' END AS interaction, CASE WHEN event_type <> 'view' THEN 'host' END AS app_host", "event_type <> 'click'"))
def source_purview_audit_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an event says besides its columns is kept as drift."""
    text = """named_struct('Id', concat('a', event_id div 2), 'CreationTime', 't', 'Operation', event_type, 'Workload', if(event_type = 'view', 'AI', 'Exchange'), 'ClientIP', concat('ip', user_id), 'AppHost', 'host',
        'CopilotEventData', if(event_type IN ('click', 'view'), NULL, named_struct('AppIdentity', 'inner', 'AppHost', 'host')))"""
    said = lambda k: F.get_json_object("_drift", f"$.{k}")
    return _valid(spark, sf_dir, "purview_audit", text).select("record_id", said("ClientIP").alias("client"), said("CopilotEventData").alias("interaction"), said("app_host").alias("app_host"))


@query("source_purview_dspm", _first("'i' || h AS dspm_agent_instance_id, event_id AS dlp_violations, '[\"s\"]' AS sensitivity_accessed"))
def source_purview_dspm(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "named_struct('dspm_agent_instance_id', concat('i', event_id div 2), 'dlp_violations', event_id, 'sensitivity_accessed', array('s'))"
    return _valid(spark, sf_dir, "purview_dspm", text).select("dspm_agent_instance_id", "dlp_violations", "sensitivity_accessed")

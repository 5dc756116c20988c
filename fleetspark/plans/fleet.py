"""Registered queries of the fleet's catalogue: near-duplicate agents, rates, trends, stores and the star load as one run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.operators import similar, trends
from fleetspark.plans.catalog import table
from fleetspark.plans.registry import query
from fleetspark.sources import landing, pipelines, star_load
from fleetspark.sources.scratch import folder
from fleetspark.sources.store import Store

# Copies of a prompt with the words of one place left out or put in are near; the twin compares all pairs of distinct sets of words.
_SIMILAR = r"""
WITH RECURSIVE told AS MATERIALIZED (SELECT doc_id AS agent_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS words FROM documents),
terms AS MATERIALIZED (SELECT agent_id, list_sort(list_distinct(words)) AS terms FROM told WHERE len(words) > 0),
sets AS MATERIALIZED (SELECT min(agent_id) AS set_id, terms, len(terms) AS n FROM terms GROUP BY terms),
flat AS MATERIALIZED (SELECT set_id, n, unnest(terms) AS term FROM sets),
edges AS MATERIALIZED (SELECT a.set_id AS a, b.set_id AS b FROM flat a JOIN flat b ON a.term = b.term AND a.set_id <> b.set_id AND a.n >= 0.8 * b.n AND b.n >= 0.8 * a.n
    GROUP BY a.set_id, b.set_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*))),
reach AS (SELECT set_id AS node, set_id AS seen FROM sets UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.seen),
labels AS MATERIALIZED (SELECT node, min(seen) AS label FROM reach GROUP BY node),
clusters AS MATERIALIZED (SELECT agent_id, label AS cluster_id, count(*) OVER (PARTITION BY label) AS members, terms FROM terms JOIN sets USING (terms) JOIN labels ON node = set_id QUALIFY members > 1),
counts AS MATERIALIZED (SELECT agent_id, term, count(*) AS tf FROM (SELECT agent_id, unnest(words) AS term FROM told) GROUP BY 1, 2),
held AS (SELECT term, ln(((SELECT count(*) FROM terms) + 1.0) / (count(*) + 1.0)) AS idf FROM counts GROUP BY term),
weights AS MATERIALIZED (SELECT agent_id, cluster_id, term, tf * idf AS w FROM counts JOIN held USING (term) JOIN clusters USING (agent_id)),
norms AS (SELECT agent_id, sqrt(sum(w * w)) AS norm FROM weights GROUP BY 1),
dots AS (SELECT x.agent_id, sum(x.w * y.w) AS dot FROM weights x JOIN weights y ON y.agent_id = x.cluster_id AND y.term = x.term GROUP BY 1)
SELECT c.agent_id, c.cluster_id, c.members, round(len(list_intersect(c.terms, f.terms)) / len(list_distinct(list_concat(c.terms, f.terms))), 6) AS jaccard,
    round(coalesce(dot / (n.norm * m.norm), 0), 6) AS cosine
FROM clusters c JOIN clusters f ON f.agent_id = c.cluster_id JOIN norms n ON n.agent_id = c.agent_id JOIN norms m ON m.agent_id = c.cluster_id LEFT JOIN dots d ON d.agent_id = c.agent_id
"""


@query("similar_agents", _SIMILAR)
def similar_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.withColumns({c: F.round(c, 6) for c in ("jaccard", "cosine")})


# --- the star load as one run ------------------------------------------------------------------------------------------

_STAMP = "strftime({}, '%Y-%m-%dT%H:00:00Z')"
_STAR = f"""
WITH ev AS (SELECT *, 1 + event_id % 2 AS b, {_STAMP.format('ts')} AS stamp, CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INT) AS d FROM events),
br AS (SELECT 'bridge' || p_partkey AS id, 'm365|p' || p_partkey AS agent FROM part WHERE p_partkey % 20 <> 0),
f AS (SELECT b, event_id AS o, 't' || CAST(event_id // 10 AS VARCHAR) AS trace_id, 's' || CAST(event_id // 2 AS VARCHAR) AS span_id, stamp, d, 'u' || user_id AS caller, CASE event_type WHEN 'purchase' THEN 'invoke_agent' ELSE event_type END AS op, CAST(event_id % 5 AS VARCHAR) AS status,
    CASE WHEN user_id % 3 = 0 THEN NULL WHEN user_id % 4 = 0 THEN 'bridge' || (user_id % 120) || ':' || (event_id % 3) ELSE 'agent' || (user_id % 120) END AS native,
    CASE WHEN event_id % 8 < 2 THEN 'amazon.nova-' || (event_id % 8) WHEN event_id % 8 < 7 THEN 'gpt-' || (event_id % 8) ELSE '(unknown)' END AS model, event_id % 100 AS prompt, CASE WHEN event_id % 9 = 0 THEN 0 ELSE CAST(floor(value) AS BIGINT) END AS total
    FROM ev WHERE event_type IN ('purchase', 'view', 'click')),
firsts AS (SELECT b, trace_id, arg_min(native, o) AS native FROM f WHERE native IS NOT NULL GROUP BY 1, 2),
fr AS (SELECT f.*, coalesce(own.agent, through.agent, 'azure|(unattributed)') AS agent, CASE WHEN own.agent IS NOT NULL THEN 'bridge' WHEN through.agent IS NOT NULL THEN 'correlation' ELSE 'unattributed' END AS tier
    FROM f LEFT JOIN br own ON own.id = regexp_replace(f.native, ':[^:]*$', '') LEFT JOIN firsts USING (b, trace_id) LEFT JOIN br through ON through.id = regexp_replace(firsts.native, ':[^:]*$', '')),
a AS (SELECT b, event_id AS o, CASE WHEN event_id % 6 <> 1 THEN 't' || CAST(event_id // 10 AS VARCHAR) END AS trace_id, 's' || CAST(event_id // 2 AS VARCHAR) AS span_id, stamp, d, 'c' || user_id AS caller, event_type AS op, CASE WHEN event_type = 'error' THEN 'boom' END AS status,
    CASE WHEN event_id % 3 = 0 THEN 'svc' || (user_id % 7) WHEN event_id % 3 = 1 THEN 'ag' || (user_id % 5) WHEN event_id % 4 = 0 THEN 'arn' || (user_id % 3) END AS native, CASE WHEN event_id % 4 = 0 THEN 'arn' || (user_id % 3) END AS endpoint,
    CASE WHEN event_id % 5 = 0 THEN 'lambda' END AS type, CASE WHEN event_id % 5 <> 2 THEN 'm' || (event_id % 5) ELSE '(unknown)' END AS model FROM ev WHERE event_type IN ('error', 'signup')),
ar AS (SELECT *, 'aws|' || coalesce(native, '(unattributed)') AS agent, CASE WHEN native IS NULL THEN 'unattributed' ELSE 'native' END AS tier FROM a),
orders_ AS (SELECT *, 1 + o_orderkey % 2 AS b, strftime(DATE '2024-01-01' + CAST(o_orderkey % 31 AS INT), '%Y-%m-%d') AS stamp, CAST(20240101 + o_orderkey % 31 AS INT) AS d FROM orders),
used AS (SELECT b, o, agent, 'azure|' || m AS metric, model, stamp, d, v, tier FROM (SELECT b, o, agent, model, stamp, d, tier, unnest(['prompt_tokens', 'total_tokens', 'latency_ms']) || '|gen_ai' AS m, unnest([prompt, total, CASE WHEN op = 'invoke_agent' THEN o END]) AS v FROM fr) WHERE v IS NOT NULL
    UNION ALL SELECT b, o, agent, 'aws|token_count|gen_ai', model, stamp, d, o, tier FROM ar
    UNION ALL SELECT b, o_orderkey, 'azure|(unattributed)', 'azure|Requests|', CASE WHEN o_custkey % 5 = 0 THEN '(unknown)' ELSE 'gpt-' || (o_custkey % 5) END, stamp, d, CAST(floor(o_totalprice) AS BIGINT), 'unattributed' FROM orders_ WHERE o_orderkey % 7 <> 0
    UNION ALL SELECT b, o_orderkey, 'aws|(unattributed)', 'aws|Invocations|' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'ns' END, 'amazon.nova-' || (o_custkey % 2), stamp, d, o_custkey, 'unattributed' FROM orders_),
consumed AS (SELECT agent, metric, CASE WHEN model LIKE 'amazon.%' THEN 'aws' ELSE split_part(metric, '|', 1) END || '|' || model AS model, stamp, d, v, tier FROM used QUALIFY row_number() OVER (PARTITION BY agent, metric, model, stamp ORDER BY b DESC, o DESC) = 1),
spans AS (SELECT b, o, trace_id, span_id, agent, tier, caller, op, status, native, model, prompt AS i, CAST(NULL AS BIGINT) AS e, nullif(total, 0) AS t, d FROM fr UNION ALL SELECT b, o, trace_id, span_id, agent, tier, caller, op, status, native, model, nullif(o, 0), 7, o, d FROM ar WHERE trace_id IS NOT NULL),
s1 AS (SELECT * FROM spans WHERE b = 1), s2 AS (SELECT * FROM spans WHERE b = 2),
merged AS (SELECT coalesce(s1.trace_id, s2.trace_id) AS trace_id, coalesce(s1.span_id, s2.span_id) AS span_id, coalesce(s2.agent, s1.agent) AS agent, coalesce(s2.tier, s1.tier) AS tier, coalesce(s2.caller, s1.caller) AS caller, CASE WHEN s2.b = 2 THEN s2.t ELSE s1.t END AS t,
    CASE WHEN s1.b = 1 THEN s1.op ELSE s2.op END AS op, CASE WHEN s1.b = 1 THEN s1.status ELSE s2.status END AS status, CASE WHEN s1.b = 1 THEN s1.native ELSE s2.native END AS native, coalesce(s1.model, s2.model) AS model, CASE WHEN s1.b = 1 THEN s1.i ELSE s2.i END AS i, coalesce(s1.d, s2.d) AS d
    FROM s1 FULL JOIN s2 ON s1.trace_id = s2.trace_id AND s1.span_id = s2.span_id),
born AS (SELECT b, native, coalesce(CASE WHEN o % 3 = 0 THEN native END, native) AS name, type, endpoint FROM a WHERE native IS NOT NULL QUALIFY row_number() OVER (PARTITION BY b, native ORDER BY o) = 1),
agents AS (SELECT 'aws|' || native AS k, max(name) AS name, coalesce(max(type) FILTER (WHERE b = 2), max(type) FILTER (WHERE b = 1)) AS type, coalesce(max(endpoint) FILTER (WHERE b = 2), max(endpoint) FILTER (WHERE b = 1)) AS description, 'active' AS status, 1 AS enabled FROM born GROUP BY native
    UNION ALL SELECT 'm365|p' || p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'new ' ELSE '' END || p_name, p_brand, p_type, 'all', CASE WHEN p_partkey % 3 = 0 THEN 0 END FROM part
    UNION ALL SELECT c || '|(unattributed)', NULL, NULL, NULL, NULL, NULL FROM (SELECT unnest(['aws', 'azure', 'm365']) AS c)),
audits AS (SELECT b, 'a' || CAST(event_id // 4 AS VARCHAR) AS record_id, event_id AS o, d, CASE WHEN event_id % 5 <> 0 THEN 'u' || user_id END AS upn, CASE WHEN event_id % 3 = 0 THEN 'p' || (user_id % 250) WHEN event_id % 3 = 1 THEN 'p' || (user_id % 90) END AS native, CASE WHEN event_id % 3 <> 2 THEN 'host' || (event_id % 4) END AS host
    FROM ev WHERE event_type = 'view' QUALIFY row_number() OVER (PARTITION BY b, event_id // 4 ORDER BY event_id DESC) = 1),
keyed AS (SELECT audits.*, coalesce('m365|' || 'p' || p_partkey, 'm365|(unattributed)') AS agent, CASE WHEN p_partkey IS NULL THEN 'unattributed' ELSE 'native' END AS tier FROM audits LEFT JOIN part ON 'p' || p_partkey = native),
a1 AS (SELECT * FROM keyed WHERE b = 1), a2 AS (SELECT * FROM keyed WHERE b = 2),
audited AS (SELECT coalesce(a1.record_id, a2.record_id) AS record_id, coalesce(a2.agent, a1.agent) AS agent, coalesce(a2.tier, a1.tier) AS tier, CASE WHEN a2.b = 2 THEN a2.upn ELSE a1.upn END AS upn, CASE WHEN a1.b = 1 THEN a1.native ELSE a2.native END AS native, CASE WHEN a1.b = 1 THEN a1.host ELSE a2.host END AS host FROM a1 FULL JOIN a2 USING (record_id)),
costs AS (SELECT 'r' || (o_custkey % 50) AS r, d, o_orderpriority AS m, CAST(floor(o_totalprice) AS BIGINT) AS v, CASE WHEN o_orderkey % 3 = 0 THEN 'EUR' END AS c FROM orders_ WHERE o_orderkey % 11 <> 0 QUALIFY row_number() OVER (PARTITION BY o_custkey % 50, d, o_orderpriority ORDER BY b DESC, o_orderkey DESC) = 1)
SELECT 'dim_agent' AS table_name, k, concat_ws('|', coalesce(name, '-'), coalesce(type, '-'), coalesce(description, '-'), coalesce(status, '-'), coalesce(CAST(enabled AS VARCHAR), '-'), coalesce(substr(sha256(trim(description)), 1, 16), '-')) AS v FROM agents
UNION ALL SELECT 'fact_agent_traces', trace_id || '|' || span_id, concat_ws('|', agent, tier, caller, coalesce(CAST(t AS VARCHAR), '-'), op, coalesce(status, '-'), coalesce(native, '-'), model, coalesce(CAST(i AS VARCHAR), '-'), CAST(d AS VARCHAR)) FROM merged
UNION ALL SELECT 'fact_agent_consumption', concat_ws('|', agent, metric, model, stamp), concat_ws('|', CAST(v AS VARCHAR), CASE WHEN tier = 'unattributed' THEN '0' ELSE '1' END, tier, CAST(d AS VARCHAR)) FROM consumed
UNION ALL SELECT 'fact_agent_snapshot', concat_ws('|', agent, metric, CAST(d AS VARCHAR)), CAST(CAST(sum(v) AS BIGINT) AS VARCHAR) || '|' || CAST(count(*) AS VARCHAR) FROM consumed GROUP BY agent, metric, d
UNION ALL SELECT 'fact_agent_audit', record_id, concat_ws('|', agent, tier, coalesce(upn, '-'), coalesce(native, '-'), coalesce(host, '-')) FROM audited
UNION ALL SELECT 'fact_resource_cost', concat_ws('|', r, CAST(d AS VARCHAR), m), CAST(v AS VARCHAR) || '|' || coalesce(c, '-') FROM costs
UNION ALL SELECT 'etl_load_log', 'rows', CAST((SELECT count(*) FROM f) + (SELECT count(*) FROM a) + 3 * (SELECT count(*) FROM orders) + (SELECT count(*) FROM events WHERE event_type = 'view') AS VARCHAR)
UNION ALL SELECT 'dim_date', 'days', CAST(count(*) AS VARCHAR) FROM (SELECT d FROM consumed UNION SELECT d FROM spans UNION SELECT d FROM costs UNION SELECT d FROM audits)
UNION ALL SELECT 'versions', 'loads', '3'
"""


def _landings(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Rows of the raw sources, with their landing (1 or 2) in ``b`` and their order in ``o``."""
    events = table(spark, sf_dir, "events").selectExpr("*", "1 + event_id % 2 AS b", "event_id AS o", "date_format(ts, \"yyyy-MM-dd'T'HH:00:00'Z'\") AS timestamp", "concat('s', event_id div 2) AS span_id")
    orders = table(spark, sf_dir, "orders").selectExpr("*", "1 + o_orderkey % 2 AS b", "o_orderkey AS o", "date_format(date_add(DATE '2024-01-01', int(o_orderkey % 31)), 'yyyy-MM-dd') AS day")
    return {
        "foundry_traces": events.where("event_type IN ('purchase', 'view', 'click')").selectExpr(
            "b", "o", "concat('t', event_id div 10) AS trace_id", "span_id", "timestamp", "concat('u', user_id) AS caller_id", "if(event_type = 'purchase', 'invoke_agent', event_type) AS span_kind", "string(event_id % 5) AS status_code",
            "CASE WHEN user_id % 3 = 0 THEN NULL WHEN user_id % 4 = 0 THEN concat('bridge', user_id % 120, ':', event_id % 3) ELSE concat('agent', user_id % 120) END AS gen_ai_agent_id",
            "CASE WHEN event_id % 8 < 2 THEN concat('amazon.nova-', event_id % 8) WHEN event_id % 8 < 7 THEN concat(' gpt-', event_id % 8) ELSE ' ' END AS deployment_name", "event_id % 100 AS prompt_tokens",
            "if(event_id % 9 = 0, 0L, bigint(floor(value))) AS total_tokens", "if(event_type = 'purchase', double(event_id), NULL) AS latency_ms",
        ),
        "bedrock_traces": events.where("event_type IN ('error', 'signup')").selectExpr(
            "b", "o", "if(event_id % 6 <> 1, concat('t', event_id div 10), NULL) AS trace_id", "span_id", "timestamp", "concat('c', user_id) AS session_id", "if(event_type = 'error', 'boom', NULL) AS error_type", "event_id AS token_count",
            "if(event_id % 3 = 1, concat('ag', user_id % 5), NULL) AS gen_ai_agent_id", "if(event_id % 4 = 0, concat('arn', user_id % 3), NULL) AS agent_endpoint_id",
            """to_json(named_struct('service_name', if(event_id % 3 = 0, concat('svc', user_id % 7), NULL), 'aws_service_type', if(event_id % 5 = 0, 'lambda', NULL), 'gen_ai_request_model', if(event_id % 5 <> 2, concat('m', event_id % 5), NULL),
                'span_name', event_type, 'span_attributes', map('gen_ai.usage.input_tokens', event_id, 'gen_ai.usage.completion_tokens', 7))) AS _drift""",
        ),
        "foundry_metrics": orders.selectExpr("b", "o", "if(o_orderkey % 7 = 0, NULL, 'Requests') AS metric_name", "day AS timestamp", "double(floor(o_totalprice)) AS value", "if(o_custkey % 5 = 0, NULL, concat('gpt-', o_custkey % 5)) AS model_deployment_name"),
        "bedrock_metrics": orders.selectExpr("b", "o", "'Invocations' AS metric_name", "day AS timestamp", "double(o_custkey) AS value", "concat('amazon.nova-', o_custkey % 2) AS model_id", "if(o_orderkey % 3 = 0, NULL, 'ns') AS namespace"),
        "foundry_cost": orders.selectExpr("b", "o", "if(o_orderkey % 11 = 0, NULL, concat('r', o_custkey % 50)) AS resource_id", "day AS charge_period_start", "double(floor(o_totalprice)) AS billed_cost", "o_orderpriority AS meter_name", "if(o_orderkey % 3 = 0, '{\"currency\":\"EUR\"}', NULL) AS _drift"),
        "purview_audit": events.where("event_type = 'view'").selectExpr(
            "b", "o", "concat('a', event_id div 4) AS record_id", "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") AS creation_date", "if(event_id % 5 <> 0, concat('u', user_id), NULL) AS user_id", "if(event_id % 3 = 0, concat('p', user_id % 250), NULL) AS app_identity",
            "if(event_id % 3 <> 2, to_json(named_struct('CopilotEventData', named_struct('AppHost', concat('host', event_id % 4), 'TargetPlatformAgentId', concat('p', user_id % 90)))), NULL) AS _drift",
        ),
    }


def _land(spark: SparkSession, sources: dict[str, DataFrame], raw: str, number: int) -> None:
    """A landing of each source: files in the order of the rows, under the day of the run."""
    for name, rows in sources.items():
        schema = star_load.landed(name)
        told = rows.where(F.col("b") == number)
        own = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        told.repartitionByRange("o").sortWithinPartitions("o").select(*own).write.mode("append").parquet(f"{raw}/{pipelines.SOURCES[name].landing}/dt=2024-02-{number:02d}")


def _catalogue(spark: SparkSession, sf_dir: str, again: bool) -> DataFrame:
    """Catalogue pages; the second capture has a third of the agents, renamed, blocked and without a description."""
    parts = table(spark, sf_dir, "part")
    text = "named_struct('id', concat('p', p_partkey), 'displayName', p_name, 'platform', p_brand, 'longDescription', p_type, 'availableTo', 'all')"
    if again:
        parts, text = parts.where("p_partkey % 3 = 0"), "named_struct('id', concat('p', p_partkey), 'displayName', concat('new ', p_name), 'isBlocked', true)"
    return parts.select(F.to_json(F.expr(text)).alias("raw"), F.lit("catalogue").alias("_file"), F.col("p_partkey").cast("long").alias("_row"))


def loaded_star(spark: SparkSession, sf_dir: str) -> Store:
    """A store after the catalogue, a curated bridge, two landings with a second catalogue, and a run that finds nothing new."""
    store, raw, sources = Store(spark, folder(spark, "star")), folder(spark, "landing"), _landings(spark, sf_dir)
    star_load.load_star(spark, store, raw, _catalogue(spark, sf_dir, False), buckets=4)
    curate = store.begin()
    known = curate.read("dim_agent").where("cloud = 'm365' AND native_agent_id <> '(unattributed)'")
    number = F.substring("native_agent_id", 2, 20)
    curate.put("bridge_agent_identity", known.select(F.lit("foundry_otel").alias("id_namespace"), F.concat(F.lit("bridge"), number).alias("native_id"), "agent_key", F.when(number.cast("int") % 20 == 0, "2024-01-01").alias("valid_to")))
    curate.commit()
    for landing_ in (1, 2):
        _land(spark, sources, raw, landing_)
        star_load.load_star(spark, store, raw, _catalogue(spark, sf_dir, True) if landing_ == 2 else None, buckets=4)
    star_load.load_star(spark, store, raw, buckets=4)
    return store


def star_rows(store: Store, loads: int) -> DataFrame:
    """``table_name, k, v``: the tables of a store by natural keys, as text."""
    t = {n: store.read(n) for n in ("dim_agent", "dim_model", "dim_metric", "dim_user", "dim_date", "fact_agent_traces", "fact_agent_consumption", "fact_agent_snapshot", "fact_agent_audit", "fact_resource_cost", "etl_load_log")}
    agents = t["dim_agent"].select("agent_key", F.concat_ws("|", "cloud", "native_agent_id").alias("agent"))
    models = t["dim_model"].select("model_key", F.col("native_id").alias("model"), F.concat_ws("|", "cloud", "native_id").alias("cloud_model"))
    metrics = t["dim_metric"].select("metric_key", F.concat_ws("|", "cloud", "metric_name", "namespace").alias("metric"))
    said = lambda *columns: F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])
    number = lambda c: F.col(c).cast("long")
    consumed, snapshot = t["fact_agent_consumption"].withColumn("value", number("value")), t["fact_agent_snapshot"].withColumn("value_sum", number("value_sum"))
    rows = {
        "dim_agent": (t["dim_agent"], said("cloud", "native_agent_id"), said("agent_name", "agent_type", "description", "status", "enabled", "config_hash")),
        "fact_agent_traces": (t["fact_agent_traces"].join(agents, "agent_key").join(models, "model_key"), said("trace_id", "span_id"), said("agent", "resolution_tier", "caller_id", "total_tokens", "operation_name", "status", "native_agent_id", "model", "input_tokens", "date_key")),
        "fact_agent_consumption": (consumed.join(agents, "agent_key").join(models, "model_key").join(metrics, "metric_key"), said("agent", "metric", "cloud_model", "ts"), said("value", "attributed", "resolution_tier", "date_key")),
        "fact_agent_snapshot": (snapshot.join(agents, "agent_key").join(metrics, "metric_key"), said("agent", "metric", "date_key"), said("value_sum", "value_count")),
        "fact_agent_audit": (t["fact_agent_audit"].join(agents, "agent_key").join(t["dim_user"], "user_key", "left"), said("record_id"), said("agent", "resolution_tier", "upn", "native_agent_id", "app_host")),
        "fact_resource_cost": (t["fact_resource_cost"].withColumn("billed_cost", number("billed_cost")), said("resource_id", "date_key", "meter_name"), said("billed_cost", "currency")),
        "etl_load_log": (t["etl_load_log"].agg(F.sum("row_count").alias("n")), F.lit("rows"), said("n")),
        "dim_date": (t["dim_date"].agg(F.count("*").alias("n")), F.lit("days"), said("n")),
        "versions": (store.spark.range(1), F.lit("loads"), F.lit(str(loads))),
    }
    out = None
    for name, (df, key, value) in rows.items():
        part = df.select(F.lit(name).alias("table_name"), key.alias("k"), value.alias("v"))
        out = part if out is None else out.unionByName(part)
    return out


@query("star_load", _STAR)
def star_load_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end state of the star's tables; a run without news makes no version."""
    store = loaded_star(spark, sf_dir)
    return star_rows(store, len(store.versions()) - 1)  # one version is the curated bridge's


# --- trends, overlaps, chunks ------------------------------------------------------------------------------------------


@query(
    "risk_changes",
    """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, arg_max(CASE event_type WHEN 'view' THEN 'low' WHEN 'click' THEN 'low' WHEN 'signup' THEN 'medium' WHEN 'error' THEN 'high' END, event_id) AS level FROM events WHERE event_type <> 'purchase' GROUP BY 1, 2),
    w AS (SELECT *, (SELECT max(p.day) FROM d p WHERE p.user_id = d.user_id AND p.day < d.day) AS last_day FROM d)
    SELECT w.user_id AS agent_key, w.day, p.level AS before, w.level AS after, CAST(w.day - w.last_day AS INT) AS days FROM w JOIN d p ON p.user_id = w.user_id AND p.day = w.last_day WHERE p.level <> w.level""",
)
def risk_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk levels of agents by the day's last event; purchases tell no level."""
    level = F.expr("CASE event_type WHEN 'view' THEN 'low' WHEN 'click' THEN 'low' WHEN 'signup' THEN 'medium' WHEN 'error' THEN 'high' END")
    posture = table(spark, sf_dir, "events").select(F.col("user_id").alias("agent_key"), F.col("ts").cast("date").alias("day"), level.alias("level"), "event_id")
    return trends.level_changes(posture, "agent_key", "day", "level", "event_id")


@query(
    "breach_runs",
    """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE event_type IN ('error', 'signup') GROUP BY 1, 2), s AS (SELECT user_id, min(day) AS a, max(day) AS b FROM d GROUP BY 1),
    f AS (SELECT s.user_id, CAST(x AS DATE) AS day, coalesce(n, 0) AS n FROM s, unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS t(x) LEFT JOIN d ON d.user_id = s.user_id AND d.day = CAST(x AS DATE)),
    g AS (SELECT t.user_id, t.day, t.n - y.n AS step, t.day - CAST(row_number() OVER (PARTITION BY t.user_id ORDER BY t.day) AS INT) AS island FROM f t JOIN f y ON y.user_id = t.user_id AND y.day = t.day - 1 WHERE t.n > y.n)
    SELECT user_id AS agent_key, min(day) AS first_day, max(day) AS last_day, count(*) AS steps, CAST(sum(step) AS BIGINT) AS gained FROM g GROUP BY user_id, island HAVING count(*) >= 2""",
)
def breach_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which an agent's breaches rose, two or more in a row."""
    daily = table(spark, sf_dir, "events").where("event_type IN ('error', 'signup')").groupBy(F.col("user_id").alias("agent_key"), F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return trends.rising_runs(daily, "agent_key", "day", "n", least=2)


_DEPLOYED = "SELECT DISTINCT 'd' || CAST(o_custkey % 400 AS VARCHAR) AS deployment, DATE '2024-01-01' + CAST(o_orderkey % 31 AS INT) AS day FROM orders"


@query("orphan_deployments", f"SELECT * FROM ({_DEPLOYED}) x WHERE NOT EXISTS (SELECT 1 FROM events WHERE event_id % 3 = 0 AND 'd' || user_id = x.deployment AND CAST(ts AS DATE) BETWEEN x.day - 3 AND x.day)")
def orphan_deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deployments on days with no span of theirs on that day or the three before."""
    deployed = table(spark, sf_dir, "orders").selectExpr("concat('d', o_custkey % 400) AS deployment", "date_add(DATE '2024-01-01', int(o_orderkey % 31)) AS day")
    used = table(spark, sf_dir, "events").where("event_id % 3 = 0").selectExpr("concat('d', user_id) AS deployment", "cast(ts AS date) AS day")
    return trends.orphan_days(deployed, used, "deployment", "day", 3)


_RATES = "SELECT o_custkey AS driver, o_orderkey AS rate_id, CAST(o_orderdate AS DATE) AS valid_from, CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 200 - 3 AS INT) END AS valid_to FROM orders"


@query("rate_overlaps", f"""WITH r AS (SELECT *, coalesce(valid_to, DATE '9999-12-31') AS e FROM ({_RATES})) SELECT i.driver, i.rate_id, i.valid_from, i.valid_to, max(j.e) AS until FROM r i
    JOIN r j ON j.driver = i.driver AND (j.valid_from, j.rate_id) < (i.valid_from, i.rate_id) AND j.valid_from < j.e WHERE i.valid_from < i.e GROUP BY ALL HAVING max(j.e) > i.valid_from""")
def rate_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates whose validity overlaps an earlier one's; some are open, some empty."""
    rates = table(spark, sf_dir, "orders").selectExpr("o_custkey AS driver", "o_orderkey AS rate_id", "cast(o_orderdate AS date) AS valid_from", "if(o_orderkey % 13 <> 0, date_add(cast(o_orderdate AS date), int(o_orderkey % 200 - 3)), NULL) AS valid_to")
    return trends.overlapping_rates(rates, ["driver"])


@query(
    "event_chunk_sink",
    """SELECT strftime(ts, '%Y-%m-%d') AS dt, CASE WHEN event_id % 2 = 0 THEN 'copilot' ELSE 'exchange' END AS service, CASE WHEN event_id % 4 < 2 THEN 'c1' ELSE 'c2' END AS chunk, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events
    WHERE event_id % 4 <> 0 OR event_id % 8 = 0 GROUP BY 1, 2, 3""",
)
def event_chunk_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two services in two chunks each over the same days; the first chunk of one runs again with half of its rows and replaces its own."""
    path, rows = folder(spark, "chunks"), table(spark, sf_dir, "events").withColumn("creation_date", F.date_format("ts", "yyyy-MM-dd HH:mm"))
    for service, chunk, where in (("Copilot", "c1", "event_id % 4 = 0"), ("Exchange", "c1", "event_id % 4 = 1"), ("Copilot", "c2", "event_id % 4 = 2"), ("Exchange", "c2", "event_id % 4 = 3"), ("Copilot", "c1", "event_id % 8 = 0")):
        landing.write_chunk(rows.where(where), path, service, chunk)
    found = spark.read.schema("event_id long, dt string, service string, chunk string").parquet(path)
    return found.groupBy("dt", "service", "chunk").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))

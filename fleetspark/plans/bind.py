"""The star's tables as views over the driver's tables, in SQL that Spark and other engines read alike.

Both the operators and their SQL twins start from these rows; the operators themselves are written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_KEY = "CAST(year({0}) * 10000 + month({0}) * 100 + day({0}) AS INT)"

#: Each view by name, and the driver's tables and views that it reads.
VIEWS = {
    "b_agent": (
        """
        SELECT CAST(s_suppkey AS BIGINT) AS agent_key,
               CASE s_suppkey % 3 WHEN 0 THEN 'aws' WHEN 1 THEN 'azure' ELSE 'm365' END AS cloud,
               concat('agent', s_suppkey) AS native_agent_id, s_name AS agent_name,
               CASE s_suppkey % 11 WHEN 0 THEN 'SharePoint' WHEN 1 THEN 'Copilot Studio' WHEN 2 THEN 'Foundry' WHEN 3 THEN 'Databricks'
                 WHEN 4 THEN 'My Declarative Agent' WHEN 5 THEN 'App for Teams' WHEN 6 THEN 'On Bedrock' WHEN 7 THEN 'Not Available'
                 WHEN 8 THEN 'Other' ELSE NULL END AS agent_type,
               CASE WHEN s_suppkey % 6 = 0 THEN NULL WHEN s_suppkey % 6 = 1 THEN '' ELSE concat('prompt ', s_suppkey % 17) END AS instructions,
               CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE concat('h', s_suppkey % 37) END AS config_hash,
               CASE WHEN s_suppkey % 7 = 0 THEN '00000000-0000-0000-0000-000000000000' ELSE concat('owner', s_suppkey % 13) END AS owner_id
        FROM supplier
        UNION ALL SELECT CAST(-1 AS BIGINT), 'aws', '(unattributed)', '(unattributed)', NULL, NULL, NULL, NULL
        UNION ALL SELECT CAST(-2 AS BIGINT), 'azure', '(unattributed)', '(unattributed)', NULL, NULL, NULL, NULL
        UNION ALL SELECT CAST(-3 AS BIGINT), 'm365', '(unattributed)', '(unattributed)', NULL, NULL, NULL, NULL
        """,
        ["supplier"],
    ),
    "b_identity": (
        """
        SELECT CAST(s_suppkey AS BIGINT) AS agent_key, 'foundry_otel' AS id_namespace, concat('bridge', s_suppkey) AS native_id,
               CASE WHEN s_suppkey % 20 = 0 THEN DATE '2024-01-01' ELSE NULL END AS valid_to
        FROM supplier WHERE s_suppkey % 4 = 0
        """,
        ["supplier"],
    ),
    "b_span": (
        f"""
        SELECT CAST(floor(event_id / 5.0) AS BIGINT) AS trace_id, event_id AS span_id, 'azure' AS cloud,
               CASE WHEN user_id % 3 = 0 THEN NULL WHEN user_id % 31 = 1 THEN 'deadbeef-0a1b-4c5d:2'
                    WHEN user_id % 4 = 0 THEN concat('bridge', user_id % 120, ':', event_id % 3)
                    ELSE concat('agent', user_id % 120, ':', event_id % 3) END AS native_agent_id,
               CASE event_type WHEN 'purchase' THEN 'invoke_agent' WHEN 'view' THEN 'chat' WHEN 'click' THEN 'execute_tool' ELSE event_type END AS operation_name,
               CASE event_type WHEN 'error' THEN '500' WHEN 'signup' THEN '404' WHEN 'view' THEN NULL ELSE '200' END AS status,
               CASE WHEN event_id % 8 < 2 THEN concat('amazon.nova-', event_id % 8) ELSE concat('gpt-', event_id % 8) END AS model_key,
               CAST(floor(value) AS BIGINT) AS total_tokens, CAST(floor(value / 4) AS BIGINT) AS input_tokens,
               CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(floor(value / 2) AS BIGINT) END AS output_tokens,
               CAST(value AS DECIMAL(18, 2)) AS duration_ms, concat('user', user_id) AS caller_id, ts, {_KEY.format("ts")} AS date_key
        FROM events
        """,
        ["events"],
    ),
    "b_cost": (
        """
        SELECT CASE WHEN o_custkey % 2 = 0 THEN 'aws' ELSE 'azure' END AS cloud, concat('/subscriptions/s', o_custkey % 9, '/resourceGroups/g', o_custkey % 5, '/r', o_custkey) AS resource_id,
               CAST(20240101 + o_orderkey % 31 AS INT) AS date_key, o_orderpriority AS meter_name, o_orderkey AS line,
               CAST(o_totalprice AS DECIMAL(18, 2)) AS billed_cost,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(18, 2)) - 100 AS DECIMAL(18, 2)) END AS effective_cost, 'EUR' AS currency
        FROM orders
        """,
        ["orders"],
    ),
    "b_audit": (
        f"""
        SELECT event_id AS record_id, concat('agent', (user_id * 7) % 130) AS native_agent_id, user_id AS user_key,
               concat('type_', event_type) AS record_type,
               CASE WHEN event_type = 'error' THEN 'Blocked' WHEN event_type = 'view' THEN '' ELSE NULL END AS error_type,
               CAST(event_id % 2 AS INT) AS dlp_evaluation_deferred, ts, {_KEY.format("ts")} AS date_key
        FROM events
        """,
        ["events"],
    ),
    "b_credits": (
        f"""
        SELECT {_KEY.format("week")} AS date_key, week AS week_start, person_id, service_id, total_credits_used, is_copilot_licensed
        FROM (SELECT CAST(date_trunc('week', ts) AS DATE) AS week, user_id AS person_id, event_type AS service_id,
                     CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DECIMAL(18, 2)) AS total_credits_used,
                     CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id % 3 = 0 END AS is_copilot_licensed
              FROM events GROUP BY CAST(date_trunc('week', ts) AS DATE), user_id, event_type) AS w
        """,
        ["events"],
    ),
}


def bound(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame."""
    text, tables = VIEWS[name]
    for table in tables:
        text = text.replace(f"FROM {table}", f"FROM {{{table}}}")
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables})


def with_views(names: list[str], query: str) -> str:
    """A query that starts from the views, as one SQL text."""
    heads = ", ".join(f"{n} AS ({VIEWS[n][0]})" for n in names)
    return f"WITH {heads}{',' if query.lstrip().startswith(',') else ''} {query.lstrip().lstrip(',')}"

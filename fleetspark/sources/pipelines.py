"""The twelve raw sources: what a record has to look like, and one job from pages to valid, quarantined and counted rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetspark.operators import flatten, quality
from fleetspark.sources.scratch import folder


@dataclass(frozen=True)
class Source:
    """A source: where it lands, its columns (``name type``), required ones, the key of a record, allowed values, how its
    payloads become records: functions of ``flatten`` in order, each with the lists a payload must have for it; and columns of
    which a record has one and a payload none (by default the required ones)."""

    landing: str
    columns: str
    required: list[str]
    key: list[str]
    enums: dict[str, list[str]] = field(default_factory=dict)
    steps: tuple[tuple[Callable[..., DataFrame], list[str]], ...] = ()
    own: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)


def _metric_points(pages: DataFrame, identity: DataFrame) -> DataFrame:
    """Points without their statistic, which is no column of the source."""
    return flatten.metric_arrays(pages, identity).drop("stat")


def _audit_records(pages: DataFrame) -> DataFrame:
    """Audit events as records (``raw``) that also hold what has no column, so that it is kept as drift."""
    flat = flatten.audit_events(pages)
    told = [c for c in flat.columns if c not in ("_file", "_row", "_pos", "_pass", "rest")]
    own = F.map_filter(F.create_map(*[v for c in told for v in (F.lit(c), F.col(c).cast("string"))]), lambda k, v: v.isNotNull())
    return flat.select(*flatten.place(flat), F.to_json(F.map_concat("rest", own)).alias("raw"))


# Record schemas, keys and landing paths of the sources.
SOURCES = {
    "bedrock_cost": Source("bedrock/cost", "time_period_start string, service string, usage_type string, operation string, unblended_cost double, usage_quantity double", ["time_period_start"], ["usage_type", "operation", "time_period_start"], steps=((flatten.cost_buckets, ["Groups"]),)),
    "bedrock_invocations": Source("bedrock/invocation_logs", "request_id string, timestamp string, schema_type string, account_id string, identity_arn string, region string, operation string, model_id string, input_token_count long, output_token_count long", ["request_id"], ["request_id", "timestamp"], steps=((flatten.log_envelope, []),)),
    "bedrock_metrics": Source("bedrock/metrics", "metric_name string, timestamp string, value double, model_id string, operation_name string, namespace string", ["metric_name", "timestamp"], ["metric_name", "model_id", "timestamp"], steps=((_metric_points, ["Timestamps", "Values"]),)),
    "bedrock_traces": Source("bedrock/traces", "span_id string, trace_id string, timestamp string, agent_endpoint_id string, session_id string, gen_ai_agent_id string, tool_invocations array<string>, latency_ms double, token_count long, error_type string", ["span_id"], ["span_id", "timestamp"], steps=((flatten.otel_spans, []),), own=("timestamp", "agent_endpoint_id", "gen_ai_agent_id", "token_count")),
    "foundry_cost": Source("foundry/cost", "resource_id string, charge_period_start string, billed_cost double, effective_cost double, consumed_quantity double, consumed_unit string, meter_category string, meter_name string, subscription_id string, resource_group string, tags map<string,string>", ["resource_id", "charge_period_start"], ["resource_id", "meter_name", "charge_period_start"], steps=((flatten.cost_rows, ["columns", "rows"]),)),
    "foundry_metrics": Source("foundry/metrics", "metric_name string, timestamp string, value double, model_deployment_name string, model_name string, model_version string, region string, api_name string, status_code string", ["metric_name", "timestamp"], ["metric_name", "model_deployment_name", "timestamp"], steps=((flatten.metric_series, ["timeseries"]),)),
    "foundry_traces": Source("foundry/traces", "span_id string, trace_id string, parent_span_id string, timestamp string, gen_ai_agent_id string, gen_ai_agent_name string, caller_id string, span_kind string, model_name string, model_version string, deployment_name string, prompt_tokens long, completion_tokens long, total_tokens long, latency_ms double, status_code string, tool_calls array<string>", ["span_id"], ["span_id", "timestamp"], steps=((flatten.table_records, ["tables"]), (flatten.gen_ai_spans, []))),
    "m365_registry": Source("m365-registry", "package_id string, agent_type string, name string, description string, publisher_email string, created string, last_modified string, deployment_status string, enabled boolean, dlp_compliant boolean, connectors array<string>, permissions array<string>", ["package_id", "agent_type"], ["package_id", "last_modified"], {"agent_type": ["copilot_studio", "agent_builder", "custom_engine", "sharepoint"]}),
    "m365_usage": Source("m365-usage", "package_id string, report_date string, agent_name string, active_users long, total_message_count long, agent_type string, last_activity string, is_anonymized boolean", ["package_id", "report_date"], ["package_id", "report_date"]),
    "m365_user_activity": Source("m365-user-activity", "user_id string, report_date string, product string, activity_count long, is_active boolean, is_anonymized boolean", ["user_id", "report_date"], ["user_id", "report_date"]),
    "purview_audit": Source("m365/purview/audit_log", "record_id string, creation_date string, record_type string, operation string, app_identity string, user_id string, workload string, sensitivity_labels array<string>, dlp_matches array<string>", ["record_id"], ["record_id", "creation_date"], steps=((_audit_records, []),)),
    "purview_dspm": Source("m365/purview/dspm_posture", "dspm_agent_instance_id string, assessment_date string, insider_risk_level string, sensitivity_accessed array<string>, dlp_violations long, oversharing_detected boolean, entra_agent_id string, package_id string", ["dspm_agent_instance_id"], ["dspm_agent_instance_id", "assessment_date"]),
}

#: The audit source when its pages are those of a Graph search.
AUDIT_GRAPH = replace(SOURCES["purview_audit"], steps=((flatten.graph_audit, []), *SOURCES["purview_audit"].steps))


def parsed(pages: DataFrame, source: Source) -> DataFrame:
    """Records (``raw``, with ``_file, _row``) as declared columns, the undeclared ones as ``_drift``, and what is wrong as ``_errors``.

    Every value is read as JSON text first and then cast, so that a value of the wrong type is told from a missing one.
    """
    fields = source.schema.fields
    record = F.explode(F.array(F.from_json("raw", "map<string,string>")))  # a generator, so that a record is parsed once, however often its values are read
    names, text = [f.name for f in fields], {f.name: F.element_at("_record", f.name) for f in fields}
    rows = pages.select("*", record.alias("_record")).withColumn("_extra", flatten.once(quality.undeclared("_record", names)))
    containers = [f for f in fields if isinstance(f.dataType, (T.ArrayType, T.MapType))]
    for f in containers:
        rows = rows.withColumn(f"_{f.name}", flatten.once(F.from_json(text[f.name], f.dataType)))

    def value(f):
        return F.col(f"_{f.name}") if f in containers else text[f.name].try_cast(f.dataType)

    wrong = [F.when(text[f.name].isNull(), F.lit(f"{f.name}: required")) for f in fields if f.name in source.required]
    wrong += [F.when(text[f.name].isNotNull() & value(f).isNull(), F.lit(f"{f.name}: not {f.dataType.simpleString()}")) for f in fields]
    wrong += [F.when(~text[k].isin(allowed), F.lit(f"{k}: not allowed")) for k, allowed in source.enums.items()]
    none = F.expr("cast(array() as array<string>)")
    checked = F.when(F.col("_record").isNull(), F.array(F.lit("not an object"))).when(F.coalesce(*wrong).isNotNull(), F.array_compact(F.array(*wrong))).otherwise(none)  # the list is made anew for each value, so only where there is an error
    return rows.select(*[value(f).alias(f.name) for f in fields], quality.drift("_record", names, F.col("_extra")).alias("_drift"), checked.alias("_errors"), "raw", "_file", "_row", "_pos")


def records(pages: DataFrame, source: Source, *context: DataFrame) -> DataFrame:
    """Pages as one JSON record a row, with ``_file, _row, _pos``. A payload that is no object, that has a column of a record already or
    that lacks a step's lists passes by the step as it is (``_pass``), in the same scan, so that validation, not the step, decides on it.
    ``context`` goes to the steps."""
    rows = flatten.dealt(pages.select("raw", "_file", "_row")).withColumn("_pos", F.expr("cast(array() as array<int>)"))
    for step, lists in source.steps:
        nested = F.col("_m").isNotNull()  # it is an object
        for k in source.own or source.required:
            nested &= ~F.map_contains_key("_m", k)
        for k in lists:
            nested &= F.schema_of_variant(F.element_at("_m", k)).startswith("ARRAY")
        parsed_once = rows.withColumn("_v", flatten.once(F.try_parse_json("raw"))).withColumn("_m", flatten.once(flatten.got("_v", "$", "map<string,variant>")))
        marked = parsed_once.withColumn("_nested", flatten.once(F.coalesce(nested, F.lit(False))))
        mine = {k: F.when(F.col("_nested"), F.col(k)) for k in ("raw", "_v", "_m")}
        flat = step(marked.withColumns({"_pass": F.when(~F.col("_nested"), F.struct("raw")), **mine}).drop("_nested"), *context)
        made = F.col("raw") if "raw" in flat.columns else F.to_json(F.struct(*[c for c in flat.columns if c not in ("_file", "_row", "_pos", "_pass")]))
        made = F.when(F.col("_pass").isNotNull(), F.col("_pass.raw")).otherwise(made)
        rows = flat.select(F.explode(F.array(made)).alias("raw"), "_file", "_row", "_pos")  # a generator, so that later expressions are not merged with the step's
    return rows


def run(pages: DataFrame, source: Source, *context: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Valid rows without repeats (containers as JSON text), quarantined rows, and one row of counts.

    Pages are read and parsed once: the parsed rows are written, counted on the way, and all three results read what they need of them.
    """
    spark, rows = pages.sparkSession, parsed(records(pages, source, *context), source)
    good = F.size("_errors") == 0
    counts, path = Observation(), folder(spark, "source")
    counted = rows.observe(counts, F.count_if(good).alias("valid"), F.count_if(~good).alias("invalid"), F.count_if(good & F.col("_drift").isNotNull()).alias("drifted"))
    counted.withColumn("raw", F.when(~good, F.col("raw"))).write.parquet(path)
    rows, told = spark.read.schema(rows.schema).parquet(path), counts.get
    names = [f.name for f in source.schema.fields]
    valid = quality.keep_first(rows.where(good), source.key, ["_file", "_row", "_pos"]).select(*names, "_drift")
    quarantine = rows.where(~good).select(F.array_join("_errors", "; ").alias("error"), "raw")
    stats = rows.where(good).select(quality.key_text(source.key).alias("k")).distinct().agg(F.count("*").alias("kept"))
    stats = stats.select("kept", (F.lit(told["valid"]) - F.col("kept")).alias("duplicates"), F.lit(told["invalid"]).alias("invalid"), F.lit(told["drifted"]).alias("drifted"))
    return quality.coerce_containers(valid), quarantine, stats

"""Nested payloads to rows: one function a shape, from a DataFrame of JSON text (column ``raw``) to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.functions import expressions as x


# Fields of an audit event's envelope that have columns of their own.
AUDIT_FIELDS = ["Id", "CreationTime", "RecordType", "Operation", "UserId", "Workload"]


def got(v: str | Column, path: str, kind: str = "string") -> Column:
    """A value of a variant, or null."""
    return F.try_variant_get(F.col(v) if isinstance(v, str) else v, path, kind)


def once(column: Column) -> Column:
    """A value that is computed once a row: a generator, so that neither expressions nor filters that read it are merged with it, nor moved before the pages are dealt out."""
    return F.explode(F.array(column))


def document(df: DataFrame) -> Column:
    """The parsed payload (``raw``), taken from ``_v`` if a caller has parsed it already."""
    return F.col("_v") if "_v" in df.columns else once(F.try_parse_json("raw"))


def members(df: DataFrame) -> Column:
    """The payload's members by name, from ``_m`` if a caller has them. A path that isn't there ends in an exception inside of ``try_variant_get``, a key that a map lacks doesn't."""
    return F.col("_m") if "_m" in df.columns else once(got(F.try_parse_json("raw"), "$", "map<string,variant>"))


def place(df: DataFrame, *at: str) -> list[Column]:
    """Where a record comes from (``_file, _row``), with its places in its page (``_pos``), if the page tells, and what it passes by with (``_pass``); else nothing."""
    if "_row" not in df.columns:
        return []
    passing = [F.col("_pass")] if "_pass" in df.columns else []
    own = [F.col("_pos")] if "_pos" in df.columns else []
    here = [F.array(*[F.col(a).cast("int") for a in at])] if at else []
    now = F.concat(*own, *here) if own or here else F.expr("cast(array() as array<int>)")
    return [F.col("_file"), F.col("_row"), (F.when(F.col("_pass").isNull(), now).otherwise(F.col("_pos")) if passing else now).alias("_pos"), *passing]


def each(df: DataFrame, items: Column, place_name: str, item_name: str) -> DataFrame:
    """A row for each item of a list. A row that passes by (``_pass`` is not null, and there is no list) stays one row."""
    if "_pass" not in df.columns:
        return df.select("*", F.posexplode(items).alias(place_name, item_name))
    return kept(df.select("*", F.posexplode_outer(items).alias(place_name, item_name)), F.col(place_name).isNotNull())


def kept(df: DataFrame, condition: Column) -> DataFrame:
    """Rows of a condition, and those that pass by."""
    return df.where(condition | F.col("_pass").isNotNull()) if "_pass" in df.columns else df.where(condition)


def dealt(pages: DataFrame) -> DataFrame:
    """Pages dealt out by their place, or else by their text. They are little to read and long to parse, so splits of files by bytes would leave most cores idle."""
    return pages.repartition(*[c for c in ("_file", "_row") if c in pages.columns] or ["raw"])


def envelope(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Objects of JSON documents that are a list, one object, or an object with the list under ``value``: ``doc, pos``."""
    parsed = df.withColumn("_v", once(F.try_parse_json(raw))).where("_v IS NOT NULL")
    kind = F.schema_of_variant("_v")
    listed = F.when(kind.startswith("ARRAY"), F.col("_v")).when(got("_v", "$.value", "variant").isNotNull(), got("_v", "$.value", "variant")).otherwise(F.parse_json(F.concat(F.lit("["), F.to_json("_v"), F.lit("]"))))
    items = parsed.withColumn("_l", listed)
    return items.selectExpr("*", "posexplode(try_variant_get(_l, '$', 'array<variant>')) AS (pos, doc)").drop("_v", "_l", raw)


def cost_buckets(df: DataFrame) -> DataFrame:
    """Day buckets with groups to a row for each day and group; amounts default to 0."""
    shape = "struct<TimePeriod:struct<Start:string>,Groups:array<struct<Keys:array<string>,Metrics:struct<UnblendedCost:struct<Amount:string>,UsageQuantity:struct<Amount:string>>>>>"
    groups = df.select("*", F.from_json("raw", shape).alias("b")).select("*", F.col("b.TimePeriod.Start").alias("time_period_start"))
    groups = each(groups, F.col("b.Groups"), "_i", "g")
    amount = lambda n: F.coalesce(F.col(f"g.Metrics.{n}.Amount").try_cast("double"), F.lit(0.0))
    return groups.select(*place(groups, "_i"), "time_period_start", F.get("g.Keys", F.lit(0)).alias("usage_type"), F.get("g.Keys", F.lit(1)).alias("operation"), amount("UnblendedCost").alias("unblended_cost"), amount("UsageQuantity").alias("usage_quantity"))


def log_envelope(df: DataFrame) -> DataFrame:
    """Log events whose message is JSON; a bad message leaves nulls and the event's id."""
    e = df.withColumn("e", document(df)).withColumn("m", once(F.try_parse_json(got("e", "$.message"))))
    return e.select(
        *place(e), got("m", "$.schemaType").alias("schema_type"), got("m", "$.identity.arn").alias("identity_arn"),
        F.coalesce(got("m", "$.requestId"), got("e", "$.eventId")).alias("request_id"), got("m", "$.timestamp").alias("timestamp"), got("m", "$.modelId").alias("model_id"), got("m", "$.operation").alias("operation"),
        got("m", "$.accountId").alias("account_id"), got("m", "$.region").alias("region"), got("m", "$.input.inputTokenCount", "bigint").alias("input_token_count"), got("m", "$.output.outputTokenCount", "bigint").alias("output_token_count"),
    )


def metric_arrays(df: DataFrame, identity: DataFrame) -> DataFrame:
    """Parallel lists of times and values to points, as many as the shorter has, with the metric's identity by query id."""
    shape = "struct<Id:string,Timestamps:array<string>,Values:array<double>>"
    r = df.select("*", F.from_json("raw", shape).alias("r")).select("*", "r.*")
    n = F.least(F.size("Timestamps"), F.size("Values"))
    zipped = r.withColumn("Timestamps", F.slice("Timestamps", F.lit(1), n)).withColumn("Values", F.slice("Values", F.lit(1), n))
    points = each(zipped, F.arrays_zip("Timestamps", "Values"), "_i", "p")
    points = points.select(*place(points, "_i"), F.col("Id").alias("id"), F.col("p.Timestamps").alias("timestamp"), F.col("p.Values").alias("value"))
    known = points.join(F.broadcast(identity.withColumn("_known", F.lit(True))), "id", "left")  # a curated row a query; its points all share the id
    return kept(known, F.col("_known").isNotNull()).drop("id", "_known").withColumn("stat", x.metric_stat("metric_name"))


def otel_spans(df: DataFrame) -> DataFrame:
    """Spans with attributes at the span or its resource, nested or flat; without a span id they go. What a source doesn't declare becomes its drift.

    Ids are spelled in camel or snake case. An empty value is as good as none; a token count under a key that is there counts even if it is null.
    """
    texts, s = "map<string,string>", df.withColumn("s", members(df))
    v = lambda k: F.element_at("s", k)
    t = lambda k: F.nullif(got(v(k), "$"), F.lit(""))
    s = kept(s.withColumn("_n", once(F.struct(F.coalesce(t("spanId"), t("span_id")).alias("id"), got(v("name"), "$").alias("name")))), F.col("_n.id").isNotNull())
    s = s.withColumn("_a", once(got(v("attributes"), "$", texts))).withColumn("_r", once(F.coalesce(got(v("resource"), "$.attributes", texts), got(v("resource"), "$", texts))))
    a = lambda k: F.nullif(F.element_at("_a", k), F.lit(""))
    r = lambda k: F.nullif(F.element_at("_r", k), F.lit(""))
    whole = lambda k: F.when(F.element_at("_a", k).isNotNull(), got(v("attributes"), f"$['{k}']", "bigint"))
    used = lambda k, alias: F.when(F.map_contains_key("_a", k), a(k)).otherwise(a(alias))
    input_, output = used("gen_ai.usage.input_tokens", "gen_ai.usage.prompt_tokens"), used("gen_ai.usage.output_tokens", "gen_ai.usage.completion_tokens")
    readable = (input_.isNull() | input_.try_cast("bigint").isNotNull()) & (output.isNull() | output.try_cast("bigint").isNotNull())
    parts = F.when(readable, x.token_total(F.lit(None).cast("bigint"), input_.try_cast("bigint"), output.try_cast("bigint")))
    tokens = F.coalesce(whole("gen_ai.usage.total_tokens"), whole("llm.usage.total_tokens"), parts)
    http = F.coalesce(F.nullif(whole("http.response.status_code"), F.lit(0)), whole("http.status_code"))
    error = x.span_error(F.coalesce(got(v("status"), "$.code"), F.lit("")), got(v("status"), "$.message"), http, a("exception.type"))
    lasted = F.when(F.schema_of_variant(v("durationNano")) != "STRING", got(v("durationNano"), "$", "double") / 1e6)
    return s.select(
        *place(s), F.col("_n.id").alias("span_id"), F.coalesce(t("traceId"), t("trace_id")).alias("trace_id"), got(v("parentSpanId"), "$").alias("parent_span_id"), F.col("_n.name").alias("operation_name"),
        x.nanos_iso(got(v("startTimeUnixNano"), "$")).alias("timestamp"), lasted.alias("latency_ms"), F.coalesce(a("gen_ai.agent.id"), a("gen_ai.agent.name"), r("service.name")).alias("gen_ai_agent_id"),
        F.coalesce(a("session.id"), a("gen_ai.conversation.id"), a("aws.bedrock.agentcore.session.id")).alias("session_id"), r("service.name").alias("service_name"), got(v("kind"), "$").alias("span_kind"), F.col("_n.name").alias("span_name"),
        F.coalesce(r("cloud.resource_id"), r("service.name")).alias("agent_endpoint_id"), F.array_compact(F.array(F.coalesce(a("gen_ai.tool.name"), a("tool.name")))).alias("tool_invocations"), r("cloud.provider").alias("cloud_provider"),
        r("cloud.region").alias("cloud_region"), r("aws.service.type").alias("aws_service_type"), a("gen_ai.request.model").alias("gen_ai_request_model"), F.col("_a").alias("span_attributes"), tokens.alias("token_count"), error.alias("error_type"),
    )


def named_rows(df: DataFrame) -> DataFrame:
    """Rows by position with a list of column names to maps; short rows lack the last names."""
    shape = "struct<columns:array<struct<name:string>>,rows:array<array<string>>>"
    t = each(df.select("*", F.from_json("raw", shape).alias("t")).select("*", F.col("t.columns.name").alias("names")), F.col("t.rows"), "_i", "row")
    n = F.least(F.size("names"), F.size("row"))
    return t.select(*place(t, "_i"), F.map_from_arrays(F.slice("names", F.lit(1), n), F.slice("row", F.lit(1), n)).alias("record"))


def cost_rows(df: DataFrame) -> DataFrame:
    """Cost lines of positional rows; a line needs a resource and a day."""
    r = lambda k: F.element_at("record", k)
    rows = named_rows(df)
    found = rows.select(
        *place(rows),
        r("ResourceId").alias("resource_id"), x.iso_day(r("UsageDate")).alias("charge_period_start"), r("Cost").try_cast("double").alias("billed_cost"), r("CostUSD").try_cast("double").alias("effective_cost"),
        r("UsageQuantity").try_cast("double").alias("consumed_quantity"), r("Meter").alias("meter_name"), r("MeterCategory").alias("meter_category"), r("Currency").alias("currency"),
        x.resource_part(r("ResourceId"), "subscriptions").alias("subscription_id"), x.resource_part(r("ResourceId"), "resourcegroups").alias("resource_group"),
    )
    return kept(found, F.col("resource_id").isNotNull() & F.col("charge_period_start").isNotNull())


def table_records(df: DataFrame) -> DataFrame:
    """The tables of a query's answer to a record (JSON text, ``raw``) for each row."""
    shape = "struct<tables:array<struct<columns:array<struct<name:string>>,rows:array<array<string>>>>>"
    t = each(df.select("*", F.from_json("raw", shape).alias("t")), F.col("t.tables"), "_i", "table")
    r = each(t, F.col("table.rows"), "_j", "row")
    n = F.least(F.size("table.columns"), F.size("row"))
    return r.select(*place(r, "_i", "_j"), F.to_json(F.map_from_arrays(F.slice("table.columns.name", F.lit(1), n), F.slice("row", F.lit(1), n))).alias("raw"))


def gen_ai_spans(df: DataFrame) -> DataFrame:
    """Spans of a dependency table with a property bag (an object, or its text): those of gen_ai scope, aliases resolved, an empty value as missing."""
    s = df.withColumn("s", document(df)).withColumn("b", once(F.coalesce(F.try_parse_json(got("s", "$.Properties")), got("s", "$.Properties", "variant"))))
    a = lambda k: F.nullif(got("s", f"$.{k}"), F.lit(""))
    p = lambda k: F.nullif(got("b", f"$['{k}']"), F.lit(""))
    n = lambda k: p(k).try_cast("double").try_cast("bigint")
    scope = p("gen_ai.system").isNotNull() | p("gen_ai.agent.id").isNotNull() | F.coalesce(p("gen_ai.operation.name").isin("invoke_agent", "create_agent"), F.lit(False))
    input_, output = F.coalesce(n("gen_ai.usage.input_tokens"), n("gen_ai.usage.prompt_tokens")), F.coalesce(n("gen_ai.usage.output_tokens"), n("gen_ai.usage.completion_tokens"))
    s = kept(s, a("Id").isNotNull() & scope)
    return s.select(
        *place(s), a("Id").alias("span_id"), a("OperationId").alias("trace_id"), a("ParentId").alias("parent_span_id"), a("TimeGenerated").alias("timestamp"),
        F.coalesce(p("user.id"), p("enduser.id"), a("UserAuthenticatedId"), a("UserId")).alias("caller_id"), F.coalesce(p("gen_ai.agent.id"), p("gen_ai.assistant.id")).alias("gen_ai_agent_id"),
        p("gen_ai.agent.name").alias("gen_ai_agent_name"), F.coalesce(p("gen_ai.operation.name"), a("Name")).alias("span_kind"),
        F.coalesce(p("gen_ai.response.model"), p("gen_ai.request.model")).alias("model_name"), p("gen_ai.request.model").alias("deployment_name"), input_.alias("prompt_tokens"), output.alias("completion_tokens"),
        F.coalesce(n("gen_ai.usage.total_tokens"), F.coalesce(input_, F.lit(0)) + F.coalesce(output, F.lit(0))).alias("total_tokens"), a("DurationMs").try_cast("double").alias("latency_ms"), a("ResultCode").alias("status_code"),
    )


def metric_series(df: DataFrame) -> DataFrame:
    """Metrics with series of points; a point's value is its total, average, count, maximum or minimum; gaps go."""
    shape = "struct<name:struct<value:string>,timeseries:array<struct<metadatavalues:array<struct<name:struct<value:string>,value:string>>,data:array<struct<timeStamp:string,total:double,average:double,count:double,maximum:double,minimum:double>>>>>"
    m = df.select("*", F.from_json("raw", shape).alias("m")).select("*", F.col("m.name.value").alias("metric_name"))
    m = each(m, F.col("m.timeseries"), "_i", "s")
    dims = F.map_from_entries(F.transform(F.coalesce("s.metadatavalues", F.expr("array()")), lambda d: F.struct(F.lower(d["name"]["value"]), d["value"])))
    points = each(m.withColumn("dims", dims), F.col("s.data"), "_j", "d")
    names = {"modeldeploymentname": "model_deployment_name", "modelname": "model_name", "modelversion": "model_version", "region": "region", "apiname": "api_name", "statuscode": "status_code"}
    value = F.coalesce("d.total", "d.average", "d.count", "d.maximum", "d.minimum")
    found = points.select(*place(points, "_i", "_j"), "metric_name", F.col("d.timeStamp").alias("timestamp"), value.alias("value"), *[F.element_at("dims", k).alias(v) for k, v in names.items()])
    return kept(found, F.col("value").isNotNull())


def graph_audit(df: DataFrame) -> DataFrame:
    """Records of a Graph audit search to audit events (``raw``): the fields of ``auditData``, and those of the record where a key is absent.

    A key that is there keeps its value, null included; so the record's fields are only added under keys that ``auditData`` lacks.
    """
    e = df.withColumn("e", document(df)).withColumn("d", once(F.coalesce(got("e", "$.auditData", "map<string,variant>"), F.expr("cast(map() as map<string,variant>)"))))
    text = lambda v: F.to_variant_object(F.struct(v.alias("v")))
    user = F.coalesce(F.nullif(got("e", "$.userPrincipalName"), F.lit("")), got("e", "$.userId"))
    said = {"Id": got("e", "$.id"), "CreationTime": got("e", "$.createdDateTime"), "Operation": got("e", "$.operation"), "UserId": user, "Workload": got("e", "$.service")}
    given = F.create_map(*[v for k, value in said.items() for v in (F.lit(k), F.try_variant_get(text(value), "$.v", "variant"))])
    lacking = F.map_filter(given, lambda k, v: ~F.map_contains_key("d", k) & v.isNotNull())
    return e.select(*place(e), F.to_json(F.map_concat(lacking, "d")).alias("raw"))


def audit_events(df: DataFrame) -> DataFrame:
    """Audit events in scope: those with an id, and interaction data or an AI workload. The identity and what else is said of the agent come from
    the interaction data alone. ``rest`` has what the event says besides, its interaction data included."""
    data = got("e", "$.CopilotEventData", "variant")
    e = df.withColumn("e", document(df)).withColumn("d", once(F.when(~F.is_variant_null(data), data)))
    t = lambda path: F.nullif(got("e", path), F.lit(""))
    i = lambda k: F.nullif(got("d", f"$.{k}"), F.lit(""))
    scope = F.col("d").isNotNull() | F.lower(got("e", "$.Workload")).isin("copilot", "aiapps", "ai")
    rest = F.map_filter(F.from_json("raw", "map<string,string>"), lambda k, v: ~k.isin(AUDIT_FIELDS) & v.isNotNull())
    identity = F.coalesce(i("AppIdentity"), i("TargetPlatformAgentId"))
    e = kept(e, scope & t("$.Id").isNotNull())
    return e.select(
        *place(e), t("$.Id").alias("record_id"), got("e", "$.CreationTime").alias("creation_date"), got("e", "$.RecordType").alias("record_type"), got("e", "$.Operation").alias("operation"),
        got("e", "$.UserId").alias("user_id"), t("$.Workload").alias("workload"), identity.alias("app_identity"), identity.alias("native_agent_id"), F.coalesce(i("AppHost"), i("ChannelName")).alias("app_host"),
        i("ErrorType").alias("error_type"), got("d", "$.DLPEvaluationDeferred", "boolean").cast("int").alias("dlp_evaluation_deferred"), rest.alias("rest"),
    )


def agent_details(df: DataFrame) -> DataFrame:
    """Catalogue entries with their definitions read: ``native_agent_id, agent_name, ..., instructions, skills, connectors``.

    Definitions are JSON inside JSON in three dialects; of a list's items, objects give their name and text is itself. Lists keep the
    order of the definitions, and in each its own items before those of its tools. Who says nothing of being blocked is neither enabled nor not.
    """
    docs = envelope(dealt(df))
    said = lambda path: x.text(got("doc", path))
    base = docs.select(
        *place(docs), "pos", said("$.id").alias("native_agent_id"), said("$.displayName").alias("agent_name"), said("$.platform").alias("agent_type"), said("$.publisher").alias("publisher"), said("$.ownerId").alias("owner_id"),
        F.coalesce(said("$.longDescription"), said("$.shortDescription")).alias("description"), (~got("doc", "$.isBlocked", "boolean")).cast("int").alias("enabled"), F.coalesce(said("$.availableTo"), said("$.deployedTo")).alias("status"),
        x.dotnet_date(got("doc", "$.createdDateTime")).alias("created"), x.dotnet_date(got("doc", "$.lastModifiedDateTime")).alias("last_modified"),
        F.expr("transform(flatten(transform(coalesce(try_variant_get(doc, '$.elementDetails', 'array<variant>'), array()), d -> coalesce(try_variant_get(d, '$.elements', 'array<variant>'), array()))), e -> try_parse_json(try_variant_get(e, '$.definition', 'string')))").alias("defs"),
    ).where("native_agent_id IS NOT NULL")
    given = lambda v, path: F.nullif(F.try_variant_get(v, path, "string"), F.lit(""))
    items = lambda d, key: F.coalesce(F.try_variant_get(d, f"$.{key}", "array<variant>"), F.expr("cast(array() as array<variant>)"))
    is_object = lambda i: F.schema_of_variant(i).startswith("OBJECT")

    def named(d: Column, key: str, *fields: str) -> Column:
        return F.transform(items(d, key), lambda i: F.when(is_object(i), F.coalesce(*[given(i, f"$.{f}") for f in fields])).otherwise(given(i, "$")))

    def tools(d: Column, kind: str, value) -> Column:
        return F.transform(F.filter(items(d, "Tools"), lambda t: F.try_variant_get(t, "$.metadata.tool_type", "string") == kind), value)

    skills = F.transform("defs", lambda d: F.concat(named(d, "capabilities", "name"), tools(d, "capability", lambda t: F.coalesce(given(t, "$.metadata.capability_type"), given(t, "$.name")))))
    connectors = F.transform("defs", lambda d: F.concat(named(d, "actions", "name", "id"), F.transform(tools(d, "api_action", lambda t: given(t, "$.name")), lambda n: x.connector_service(n))))
    clean = lambda a: F.array_distinct(F.array_compact(F.flatten(F.filter(a, lambda v: v.isNotNull()))))
    prompt = F.try_element_at(F.filter(F.transform("defs", lambda d: F.coalesce(given(d, "$.instructions"), given(d, "$.Instructions"))), lambda i: i.isNotNull()), F.lit(1))
    found = base.withColumns({"instructions": prompt, "skills": clean(skills), "connectors": clean(connectors)}).drop("defs")
    told = F.coalesce("instructions", "description")
    return found.withColumn("config_hash", F.when(x.text(told).isNotNull(), x.hash16(told)))


def wide_to_long(df: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """A column a workload to a row a workload; blanks go."""
    long = df.unpivot(keys, columns, name, "_v").where(F.trim("_v") != "")
    return long.select(*keys, name, F.trim("_v").try_cast("int").alias(value))

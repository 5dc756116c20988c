"""The star's load as one run: landed files that no run has read, in order of their dependencies, to tables that change together.

Catalogue and spans give agents, then spans, metrics, costs and audit events become facts, and of the rollup the touched days are made anew.
Which files were read is a table of the same version as the data, so a load that stops leaves neither. Rows count in the order of source, file and row.

Of the rows of one key in a run the last counts, and what a known key keeps is in ``facts.UPDATE_SETS``. Agents take the first attributes of a
run and the newest that isn't null across runs. Sentinels of all clouds are always there.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetspark.functions import expressions as x
from fleetspark.operators import facts, flatten, quality, star
from fleetspark.sources import landing, pipelines
from fleetspark.sources.scratch import folder
from fleetspark.sources.store import Load, Store, bucket

# The owner of packages that nobody owns, and the clouds with a sentinel.
NULL_OWNER = "00000000-0000-0000-0000-000000000000"
CLOUDS = ["aws", "azure", "m365"]
#: Tables that a rebuild keeps: they are curated, not loaded.
CURATED = ["bridge_agent_identity"]

AGENT = ["agent_name", "agent_type", "description", "instructions", "config_hash", "status", "enabled", "publisher", "owner_id", "created", "last_modified"]
ORDER = ["_source", "_file", "_row"]
#: Parts of tables whose keys hold no day; a store keeps its number.
BUCKETS = 64


def landed(source: str) -> T.StructType:
    """A source's columns as they are landed: lists and maps are text, and there is the drift."""
    held = (T.ArrayType, T.MapType)
    fields = [T.StructField(f.name, T.StringType() if isinstance(f.dataType, held) else f.dataType) for f in pipelines.SOURCES[source].schema]
    return T.StructType([*fields, T.StructField("_drift", T.StringType())])


def _day() -> Column:
    return F.coalesce(F.col("date_key").cast("string"), F.lit("none"))


@dataclass
class Run:
    """One load: what it reads, and the tables it changes."""

    spark: SparkSession
    load: Load
    raw: str
    full_scan: bool = False
    buckets: int = BUCKETS

    def __post_init__(self):
        log = self.load.read("etl_load_log")
        self.logged = set() if log is None or self.full_scan else {r["file_path"] for r in log.select("file_path").collect()}  # names of files, as Spark lists them itself
        self.read_files: list[DataFrame] = []
        self.days: list[DataFrame] = []

    def rows(self, source: str, place: int) -> DataFrame | None:
        """Rows of a source's files that no run has read, with ``_source, _file, _row``; None if there is no such file."""
        path, schema = f"{self.raw}/{pipelines.SOURCES[source].landing}", landed(source)
        try:
            files = sorted(self.spark.read.schema(schema).parquet(path).inputFiles())
        except Exception as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return None
        new = [f for f in files if self.relative(f) not in self.logged]
        if not new:
            return None
        found = landing.scan(self.spark, new, schema).withColumn("_source", F.lit(place))
        self.read_files.append(found.groupBy("_file").agg(F.count("*").alias("row_count")))
        return found

    def relative(self, file: str) -> str:
        return file.partition(self.raw.rstrip("/").removeprefix("file://").removeprefix("file:") + "/")[2] or file

    # --- dimensions ---

    def numbered(self, name: str, naturals: DataFrame, natural: list[str], key: str) -> DataFrame:
        """The key map of a dimension, with numbers for new naturals; numbers once given stay."""
        known = self.load.read(name)
        known = naturals.select(*natural, F.lit(0).cast("long").alias(key)).where("false") if known is None else known
        fresh = naturals.select(natural).distinct().join(known, natural, "left_anti")
        if fresh.isEmpty():
            return known
        self.load.put(name, facts.with_keys(known, naturals, natural, key))
        return self.load.read(name)

    def agents(self, batch: DataFrame) -> DataFrame:
        """``dim_agent`` with a batch (``cloud, native_agent_id``, attributes, ``ORDER``) merged in."""
        known = self.load.read("dim_agent")
        kinds = ", ".join(f"{c} {'int' if c == 'enabled' else 'string'}" for c in AGENT)
        known = self.spark.createDataFrame([], f"agent_key long, cloud string, native_agent_id string, {kinds}") if known is None else known
        natural = ["cloud", "native_agent_id"]
        merged = facts.merge_newest(known.drop("agent_key"), batch, natural, ORDER)
        keys = facts.with_keys(known, merged, natural, "agent_key")
        self.load.put("dim_agent", keys.join(merged, natural).select(known.columns))
        return self.load.read("dim_agent")

    def on_days(self, df: DataFrame) -> DataFrame:
        self.days.append(df.select("date_key"))
        return df


def no_agents(spark: SparkSession) -> DataFrame:
    kinds = ", ".join(f"{c} {'int' if c == 'enabled' else 'string'}" for c in AGENT)
    return spark.createDataFrame([], f"cloud string, native_agent_id string, {kinds}, _source int, _file string, _row long")


def sentinels(spark: SparkSession) -> DataFrame:
    return no_agents(spark).unionByName(spark.createDataFrame([(c, facts.SENTINEL, -1) for c in CLOUDS], "cloud string, native_agent_id string, _source int"), allowMissingColumns=True)


def registered(catalogue: DataFrame) -> DataFrame:
    """Agents of a catalogue (``raw, _file, _row``), without the ghosts of agents that have an owner. Pages are parsed once, and the agents stored."""
    details = _kept(flatten.agent_details(catalogue), "details")
    named = details.withColumns({"display_name": F.col("agent_name"), "platform": F.col("agent_type")})
    owner = F.coalesce(F.col("owner_id"), F.lit(""))  # an owner that isn't told is no ghost, and no real owner either
    real = named.where((owner != NULL_OWNER) & (owner != "")).select("display_name", "platform").distinct()
    twin = real.select(F.col("display_name").alias("_n"), F.col("platform").alias("_p"))
    ghosts = named.where(owner == NULL_OWNER)
    alone = ghosts.join(twin, F.col("display_name").eqNullSafe(F.col("_n")) & F.col("platform").eqNullSafe(F.col("_p")), "left_anti")
    kept = named.where(owner != NULL_OWNER).unionByName(alone)
    return _kept(kept.withColumns({"cloud": F.lit("m365"), "_source": F.lit(0), "_row": F.col("_row") * (1 << 32) + F.col("pos")}), "listed")


def resolved(spans: DataFrame, agents: DataFrame, identity: DataFrame, namespace: str, cloud: str, first: DataFrame) -> DataFrame:
    """``spans`` with ``agent_key, resolution_tier``: the span's id by bridge (its base) or catalogue, then the first id of its trace, then the sentinel.

    ``first`` has ``trace_id, trace_agent``. Ids are looked up once each, and spans without an id or a trace are set apart before the joins, so that
    nulls, which may be most rows, meet nowhere.
    """
    bridge = identity.where((F.col("id_namespace") == namespace) & F.col("valid_to").isNull()).groupBy(F.col("native_id").alias("_b")).agg(F.min("agent_key").alias("_bk"))
    native = agents.where((F.col("cloud") == cloud) & (F.col("native_agent_id") != facts.SENTINEL)).select(F.col("native_agent_id").alias("_n"), F.col("agent_key").alias("_nk"))
    ids = spans.select(F.col("native_agent_id").alias("_id")).unionByName(first.select(F.col("trace_agent").alias("_id"))).where("_id IS NOT NULL").distinct()
    found = ids.join(bridge, x.identity_base("_id") == F.col("_b"), "left").join(native, F.col("_id") == F.col("_n"), "left").where("_bk IS NOT NULL OR _nk IS NOT NULL")
    found = found.select("_id", F.coalesce("_bk", "_nk").alias("_key"), F.when(F.col("_bk").isNotNull(), "bridge").otherwise("native").alias("_tier"))
    by_id = spans.where("native_agent_id IS NOT NULL").join(found, F.col("native_agent_id") == F.col("_id"), "left").drop("_id")
    own = by_id.unionByName(spans.where("native_agent_id IS NULL"), allowMissingColumns=True)
    traces = first.join(found, F.col("trace_agent") == F.col("_id")).select("trace_id", F.col("_key").alias("_tk"))
    open_ = F.col("_key").isNull() & F.col("trace_id").isNotNull()
    through = own.where(open_).join(traces, "trace_id", "left").unionByName(own.where(~open_), allowMissingColumns=True)
    none = agents.where((F.col("cloud") == cloud) & (F.col("native_agent_id") == facts.SENTINEL)).agg(F.min("agent_key").alias("_none"))
    tier = F.coalesce("_tier", F.when(F.col("_tk").isNotNull(), "correlation").otherwise("unattributed"))
    keyed = through.crossJoin(F.broadcast(none))  # one row
    return keyed.withColumns({"agent_key": F.coalesce("_key", "_tk", "_none"), "resolution_tier": tier}).drop("_key", "_tier", "_tk", "_none")


def measured(rows: DataFrame, cloud: str, measures: list[str]) -> DataFrame:
    """Consumption rows of spans, one a measure (``m_`` and its name) that is there; of a span's measures each has its own key."""
    kept = ["agent_key", "resolution_tier", "model", "date_key", "ts", *ORDER]
    long = rows.select(*kept, *[F.col(f"m_{m}").cast("double").alias(m) for m in measures]).unpivot(kept, measures, "metric_name", "value").where("value IS NOT NULL")
    return long.withColumns({"cloud": F.lit(cloud), "namespace": F.lit("gen_ai"), "attributed": (F.col("resolution_tier") != "unattributed").cast("int")})


def foundry_spans(run: Run, rows: DataFrame, agents: DataFrame, carry: bool) -> DataFrame:
    """Spans of the first layout with their agents; with ``carry`` the first id of a trace is one that any run has seen."""
    t = {c: x.text(c) for c in ("trace_id", "span_id", "parent_span_id", "caller_id")}
    known = {"ts": x.text("timestamp"), "native_agent_id": x.text("gen_ai_agent_id"), "model": star.or_unknown("deployment_name"), "operation_name": x.text("span_kind"), "status": x.text("status_code"), "tool_name": F.lit(None).cast("string")}
    numbers = {"duration_ms": F.col("latency_ms"), "input_tokens": F.col("prompt_tokens"), "output_tokens": F.col("completion_tokens"), "total_tokens": F.nullif("total_tokens", F.lit(0))}
    measures = {c: F.col(c).alias(f"m_{c}") for c in ("prompt_tokens", "completion_tokens", "total_tokens", "latency_ms")}
    every = rows.select(*[c.alias(n) for n, c in {**t, **known, **numbers}.items()], *measures.values(), *ORDER)
    ids = facts.first_agent_by_trace(every, ORDER)
    if carry:
        run.load.merge("trace_agent", ids, ["trace_id"], [], bucket("trace_id", of=run.buckets))
        here = every.select("trace_id").where("trace_id IS NOT NULL").distinct()
        seen = run.load.read("trace_agent", [r["p"] for r in here.select(bucket("trace_id", of=run.buckets).alias("p")).distinct().collect()])
        ids = ids if seen is None else seen.join(here, "trace_id", "left_semi")
    identity = run.load.read("bridge_agent_identity")
    identity = run.spark.createDataFrame([], "id_namespace string, native_id string, agent_key long, valid_to string") if identity is None else identity
    spans = resolved(every.where("ts IS NOT NULL"), agents, identity, "foundry_otel", "azure", ids)
    return spans.withColumns({"span_kind": x.span_kind("operation_name"), "date_key": x.date_key("ts"), "cloud": F.lit("azure")})


def bedrock_spans(rows: DataFrame) -> DataFrame:
    """Spans of the second layout, as ``star.bedrock_span_fact`` reads them, those without a trace too: they have consumption and no span row."""
    d = rows.withColumn("_d", x.drift_object("_drift")).withColumn("_a", x.drift_object(F.try_variant_get("_d", "$.span_attributes", "string")))
    said = lambda path: x.text(F.try_variant_get("_d", f"$.{path}", "string"))
    used = lambda *names: F.coalesce(*[x.safe_long(F.nullif(F.try_variant_get("_a", f"$['gen_ai.usage.{n}']", "string"), F.lit("0"))) for n in names])
    native = F.coalesce(said("service_name"), x.text("gen_ai_agent_id"), x.text("agent_endpoint_id"))
    return d.select(
        x.text("trace_id").alias("trace_id"), x.text("span_id").alias("span_id"), said("parent_span_id").alias("parent_span_id"), x.text("session_id").alias("caller_id"), x.text("timestamp").alias("ts"), native.alias("native_agent_id"),
        star.or_unknown(said("gen_ai_request_model")).alias("model"), said("span_name").alias("operation_name"), said("span_kind").alias("span_kind"), x.text("error_type").alias("status"), x.first_of_list("tool_invocations").alias("tool_name"),
        F.col("latency_ms").alias("duration_ms"), used("input_tokens", "prompt_tokens").alias("input_tokens"), used("output_tokens", "completion_tokens").alias("output_tokens"), x.safe_long("token_count").alias("total_tokens"),
        F.col("token_count").alias("m_token_count"), F.col("latency_ms").alias("m_latency_ms"), said("service_name").alias("service_name"), said("aws_service_type").alias("aws_service_type"), x.text("agent_endpoint_id").alias("endpoint"), *ORDER,
    ).where("ts IS NOT NULL").withColumns({"date_key": x.date_key("ts"), "cloud": F.lit("aws")})


def born(spans: DataFrame) -> DataFrame:
    """Agents that only spans know: named by their service, typed by the runtime, described by the endpoint; active and enabled."""
    made = {
        "agent_name": F.coalesce("service_name", "native_agent_id"), "agent_type": F.col("aws_service_type"), "description": F.col("endpoint"), "config_hash": F.when(F.col("endpoint").isNotNull(), x.hash16("endpoint")),
        "status": F.lit("active"), "enabled": F.lit(1),
    }
    named = spans.where("native_agent_id IS NOT NULL").select(F.lit("aws").alias("cloud"), "native_agent_id", *[c.alias(n) for n, c in made.items()], *ORDER)
    return quality.keep_first(named, ["native_agent_id"], ORDER)


def points(rows: DataFrame, cloud: str, model: str, namespace: str | None, agents: DataFrame) -> DataFrame:
    """Metric points on the sentinel of their cloud; those without a name or a time go, and a model that isn't told is the unknown one."""
    none = agents.where((F.col("cloud") == cloud) & (F.col("native_agent_id") == facts.SENTINEL)).agg(F.min("agent_key").alias("agent_key"))
    kept = rows.select(
        x.text("metric_name").alias("metric_name"), x.text("timestamp").alias("ts"), "value", star.or_unknown(model).alias("model"), (F.coalesce(x.text(namespace), F.lit("")) if namespace else F.lit("")).alias("namespace"), *ORDER,
    ).where("metric_name IS NOT NULL AND ts IS NOT NULL")
    told = {"cloud": F.lit(cloud), "attributed": F.lit(0), "resolution_tier": F.lit("unattributed"), "date_key": x.date_key("ts")}
    return kept.withColumns(told).crossJoin(F.broadcast(none))  # one row


def audit_rows(rows: DataFrame) -> DataFrame:
    """Audit events as facts without keys: what is said of the agent comes from the interaction data in the drift."""
    e = rows.withColumn("_d", x.drift_object(F.try_variant_get(x.drift_object("_drift"), "$.CopilotEventData", "string")))
    i = lambda k: x.text(F.try_variant_get("_d", f"$.{k}", "string"))
    kept = e.where(x.text("record_id").isNotNull() & x.text("creation_date").isNotNull())
    ts = x.text("creation_date")
    return kept.select(
        x.text("record_id").alias("record_id"), F.when(ts.endswith("Z"), ts).otherwise(F.concat(ts, F.lit("Z"))).alias("ts"), x.date_key(ts).alias("date_key"), x.text("user_id").alias("upn"), x.text("record_type").alias("record_type"),
        x.text("operation").alias("operation"), x.text("workload").alias("workload"), F.coalesce(i("AppHost"), i("ChannelName")).alias("app_host"), i("ThreadId").alias("thread_id"),
        F.coalesce(x.text("app_identity"), i("AppIdentity"), i("TargetPlatformAgentId")).alias("native_agent_id"), i("TargetAgentName").alias("agent_name_raw"), i("PlatformAgentType").alias("platform_agent_type"), i("ErrorType").alias("error_type"),
        F.try_variant_get("_d", "$.DLPEvaluationDeferred", "boolean").cast("int").alias("dlp_evaluation_deferred"), x.json_or_null("dlp_matches").alias("dlp_matches"), i("SensitivityLabelId").alias("sensitivity_label_id"),
        x.json_or_null("sensitivity_labels").alias("sensitivity_labels"), x.json_or_null(F.try_variant_get("_d", "$.GuardrailDetails", "string")).alias("guardrail_details"), *ORDER,
    )


TRACES = ["trace_id", "span_id", "parent_span_id", "agent_key", "model_key", "date_key", "ts", "operation_name", "span_kind", "native_agent_id", "caller_id", "status", "duration_ms", "input_tokens", "output_tokens", "total_tokens", "tool_name", "resolution_tier"]


def load_star(spark: SparkSession, store: Store, raw: str, catalogue: DataFrame | None = None, full_scan: bool = False, rebuild: bool = False, carry_traces: bool = False, buckets: int = BUCKETS) -> bool:
    """Load what has landed under ``raw`` and a catalogue (pages: ``raw, _file, _row``); whether anything changed.

    ``full_scan`` reads files again that were read before; ``rebuild`` makes all tables but the curated ones anew beside the old, from all files,
    and switches to them at once. ``carry_traces`` keeps the first agent id of each trace from run to run; else a trace is what one run reads of it.
    """
    load = store.begin(CURATED if rebuild else None)
    run = Run(spark, load, raw, full_scan or rebuild, buckets)
    sources = ["foundry_traces", "bedrock_traces", "bedrock_metrics", "foundry_metrics", "foundry_cost", "bedrock_cost", "purview_audit"]
    rows = {s: run.rows(s, i + 1) for i, s in enumerate(sources)}
    rows = {s: df for s, df in rows.items() if df is not None}
    if not rows and catalogue is None:
        return False

    batch, listed = sentinels(spark), registered(catalogue) if catalogue is not None else None
    aws = _kept(bedrock_spans(rows["bedrock_traces"]), "spans") if "bedrock_traces" in rows else None
    for part in [df for df in (born(aws) if aws is not None else None, listed) if df is not None]:
        batch = batch.unionByName(part.select(*[c for c in batch.columns if c in part.columns]), allowMissingColumns=True)
    agents = run.agents(batch)
    keys = agents.select("cloud", "native_agent_id", "agent_key")
    if listed is not None:
        _bridges(run, listed, keys)

    spans, used = [], []
    if "foundry_traces" in rows:
        found = _kept(foundry_spans(run, rows["foundry_traces"], agents, carry_traces), "spans")
        spans.append(found)
        used.append(measured(found, "azure", ["prompt_tokens", "completion_tokens", "total_tokens", "latency_ms"]))
    if aws is not None:
        own = keys.where("cloud = 'aws'").select(F.col("native_agent_id").alias("_n"), "agent_key")
        found = aws.withColumn("_n", F.coalesce("native_agent_id", F.lit(facts.SENTINEL))).join(own, "_n").drop("_n")
        found = found.withColumn("resolution_tier", F.when(F.col("native_agent_id").isNull(), "unattributed").otherwise("native"))
        spans.append(found)
        used.append(measured(found, "aws", ["token_count", "latency_ms"]))
    if "bedrock_metrics" in rows:
        used.append(points(rows["bedrock_metrics"], "aws", "model_id", "namespace", agents))
    if "foundry_metrics" in rows:
        used.append(points(rows["foundry_metrics"], "azure", "model_deployment_name", None, agents))
    if used:
        _load_use(run, spans, used)
    if "foundry_cost" in rows:  # the other cloud's lines name no resource, so none is loaded
        cost = ["cloud", "resource_id", "date_key", "meter_name", *facts.UPDATE_SETS["fact_resource_cost"]]
        lines = star.cost_lines(rows["foundry_cost"], "azure").select(*cost, *ORDER)
        load.merge("fact_resource_cost", run.on_days(lines), cost[:4], cost[4:], _day(), ORDER)
    if "purview_audit" in rows:
        events = _kept(audit_rows(rows["purview_audit"]), "audit")
        users = run.numbered("dim_user", events.where("upn IS NOT NULL").select("upn"), ["upn"], "user_key")
        events = facts.audit_keys(events, keys).join(users, "upn", "left").drop("upn")
        load.merge("fact_agent_audit", run.on_days(events), ["record_id"], facts.UPDATE_SETS["fact_agent_audit"], bucket("record_id", of=run.buckets), ORDER)
    _dates(run)
    _log(run)
    return load.commit()


def _load_use(run: Run, spans: list[DataFrame], used: list[DataFrame]) -> None:
    """Span rows and consumption with the keys of their models and metrics, and the rollup of the days that consumption touched."""
    consumed = _kept(reduce(DataFrame.unionByName, used).withColumn("model_cloud", x.model_cloud("model", "cloud")), "used")
    kept = [c for c in TRACES if c != "model_key"]
    told = reduce(DataFrame.unionByName, [s.select(*kept, "model", "cloud", *ORDER) for s in spans]).withColumn("model_cloud", x.model_cloud("model", "cloud")) if spans else None
    named = [df.select(F.col("model_cloud").alias("cloud"), F.col("model").alias("native_id")) for df in [consumed] + [told] * (told is not None)]
    models = run.numbered("dim_model", reduce(DataFrame.unionByName, named), ["cloud", "native_id"], "model_key")
    metrics = run.numbered("dim_metric", consumed.select("cloud", "metric_name", "namespace"), ["cloud", "metric_name", "namespace"], "metric_key")
    with_model = lambda df: df.join(models.select(F.col("cloud").alias("model_cloud"), F.col("native_id").alias("model"), "model_key"), ["model_cloud", "model"])
    if told is not None:
        whole = with_model(told.where("trace_id IS NOT NULL AND span_id IS NOT NULL")).select(*TRACES, *ORDER)
        run.load.merge("fact_agent_traces", run.on_days(whole), ["trace_id", "span_id"], facts.UPDATE_SETS["fact_agent_traces"], bucket("trace_id", of=run.buckets), ORDER)
    facts_ = with_model(consumed).join(metrics, ["cloud", "metric_name", "namespace"]).select("agent_key", "metric_key", "model_key", "ts", "date_key", "value", "attributed", "resolution_tier", *ORDER)
    days = run.load.merge("fact_agent_consumption", run.on_days(facts_), ["agent_key", "metric_key", "model_key", "ts"], facts.UPDATE_SETS["fact_agent_consumption"], _day(), ORDER)
    if days:
        sums = run.load.read("fact_agent_consumption", days).groupBy("agent_key", "metric_key", "date_key").agg(F.sum("value").alias("value_sum"), F.count("*").alias("value_count"))
        run.load.put_parts("fact_agent_snapshot", sums, _day(), days)


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bridges(run: Run, listed: DataFrame, agents: DataFrame) -> None:
    """Skills and connectors of the catalogue's agents, in the order of their definitions; pairs that are known stay."""
    first = quality.keep_first(listed, ["native_agent_id"], ORDER).join(agents.where("cloud = 'm365'").select("native_agent_id", "agent_key"), "native_agent_id")
    for what, items in (("skill", "skills"), ("connector", "connectors")):
        names = first.select(F.explode(items).alias(f"{what}_name"))
        dim = run.numbered(f"dim_{what}", names, [f"{what}_name"], f"{what}_key")
        rows = star.bridge(first, "agent_key", items, dim, f"{what}_name", f"{what}_key").drop("place")
        run.load.merge(f"bridge_agent_{what}", rows, ["agent_key", f"{what}_key"], [], bucket("agent_key", of=run.buckets))


def _dates(run: Run) -> None:
    """Days of all facts that this run wrote."""
    if not run.days:
        return
    fresh, known = facts.dim_date(F.col("date_key"), reduce(DataFrame.unionByName, run.days)), run.load.read("dim_date")
    fresh = fresh if known is None else fresh.join(known.select("date_key"), "date_key", "left_anti")
    if not fresh.isEmpty():
        run.load.put("dim_date", fresh if known is None else known.unionByName(fresh))


def _log(run: Run) -> None:
    """Files read in this run, with their rows."""
    root = run.raw.rstrip("/").removeprefix("file://").removeprefix("file:") + "/"
    known = run.load.read("etl_load_log")
    for files in run.read_files:
        rows = files.select(F.substring_index("_file", root, -1).alias("file_path"), "row_count")
        known = rows if known is None else known.join(rows.select("file_path"), "file_path", "left_anti").unionByName(rows)
    if known is not None and run.read_files:
        run.load.put("etl_load_log", known)

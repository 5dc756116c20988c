"""Facts, dimensions and checks of the star that are put together from several operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.functions import expressions as x
from fleetspark.operators import facts, flatten, quality
from fleetspark.sources.scratch import stored

UNKNOWN_MODEL = "(unknown)"
CREDIT_KEY = ["date_key", "person_id", "service_id"]

# The checks of the star as (name, child, key, parent, optional); parent and child share the key's name.
STAR_CHECKS = [
    ("consumption agent", "fact_agent_consumption", "agent_key", "dim_agent", False),
    ("consumption metric", "fact_agent_consumption", "metric_key", "dim_metric", False),
    ("consumption model", "fact_agent_consumption", "model_key", "dim_model", False),
    ("consumption date", "fact_agent_consumption", "date_key", "dim_date", False),
    ("bridge_agent_skill agent", "bridge_agent_skill", "agent_key", "dim_agent", False),
    ("bridge_agent_skill skill", "bridge_agent_skill", "skill_key", "dim_skill", False),
    ("bridge_agent_connector agent", "bridge_agent_connector", "agent_key", "dim_agent", False),
    ("bridge_agent_connector connector", "bridge_agent_connector", "connector_key", "dim_connector", False),
    ("resource_cost date", "fact_resource_cost", "date_key", "dim_date", False),
    ("audit agent", "fact_agent_audit", "agent_key", "dim_agent", False),
    ("audit date", "fact_agent_audit", "date_key", "dim_date", False),
    ("audit user", "fact_agent_audit", "user_key", "dim_user", True),
]


def star_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """``check_name, orphans`` of the declared checks whose tables are there; a null key is an orphan unless it is optional.

    A child with several checks is counted once by all keys that they ask for, and stored: it may be a long plan itself, and its
    keys are few beside its rows.
    """
    here = [c for c in STAR_CHECKS if c[1] in tables and c[3] in tables]
    children = {}
    for child in dict.fromkeys(c[1] for c in here):
        keys = [c[2] for c in here if c[1] == child]
        counted = tables[child].groupBy(*keys).agg(F.count("*").alias("_rows"))
        children[child] = stored(counted, "star-keys") if len(keys) > 1 else counted
    return quality.orphans([(name, children[child], key, tables[parent], key, optional) for name, child, key, parent, optional in here], "_rows")


def orphans_not_in(checks: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """``check_name, orphans`` as NOT IN counts: a null key is no orphan, and a parent with a null key has none at all."""
    out = None
    for name, child, key, parent, parent_key in checks:
        counts = child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))  # a hot key is one row before the join
        lost = counts.join(parent.select(F.col(parent_key).alias("k")).distinct(), "k", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        nulls = parent.agg(F.count_if(F.col(parent_key).isNull()).alias("nulls"))
        row = lost.crossJoin(F.broadcast(nulls)).select(F.lit(name).alias("check_name"), F.when(F.col("nulls") > 0, 0).otherwise(F.col("n")).cast("long").alias("orphans"))  # one row each
        out = row if out is None else out.unionByName(row)
    return out


def or_unknown(model: str | Column) -> Column:
    """A model's name, or the row of models that nobody named."""
    return F.coalesce(x.text(model), F.lit(UNKNOWN_MODEL))


def bedrock_span_fact(spans: DataFrame) -> DataFrame:
    """Span facts of a cloud whose spans say most in their drift.

    Name, kind, parent, model and the token parts come from there; the session is the caller, the error the status. The
    service's name is the agent, else the agent's id, else the endpoint; without any the span is unattributed. Spans without a
    time or a key go.
    """
    timed = spans.where(x.text("timestamp").isNotNull() & x.text("trace_id").isNotNull() & x.text("span_id").isNotNull())
    texts = lambda v: F.try_variant_get(v, "$", "map<string,string>")
    d = timed.withColumn("_d", flatten.once(texts(x.drift_object("_drift"))))
    d = d.withColumn("_a", flatten.once(texts(x.drift_object(F.element_at("_d", "span_attributes")))))  # an object, or its text
    said = lambda k: x.text(F.element_at("_d", k))
    used = lambda *names: F.coalesce(*[x.safe_long(F.element_at("_a", f"gen_ai.usage.{n}")) for n in names])
    native = F.coalesce(said("service_name"), x.text("gen_ai_agent_id"), x.text("agent_endpoint_id"))
    return d.select(
        x.text("trace_id").alias("trace_id"), x.text("span_id").alias("span_id"), said("parent_span_id").alias("parent_span_id"), native.alias("native_agent_id"),
        or_unknown(said("gen_ai_request_model")).alias("model"), x.date_key("timestamp").alias("date_key"), "timestamp", said("span_name").alias("operation_name"), said("span_kind").alias("span_kind"),
        x.text("session_id").alias("caller_id"), x.text("error_type").alias("status"), "latency_ms", used("input_tokens", "prompt_tokens").alias("input_tokens"), used("output_tokens", "completion_tokens").alias("output_tokens"),
        x.safe_long("token_count").alias("total_tokens"), x.first_of_list("tool_invocations").alias("tool_name"), F.when(native.isNull(), "unattributed").otherwise("native").alias("resolution_tier"),
    )


def cost_lines(records: DataFrame, cloud: str) -> DataFrame:
    """Cost records as lines of the fact: the currency is in the drift, a line without a resource or a day goes."""
    currency = x.text(F.try_variant_get(x.drift_object("_drift"), "$.currency", "string"))
    named = records.select("*", F.lit(cloud).alias("cloud"), x.date_key("charge_period_start").alias("date_key"), currency.alias("currency"))
    return named.where(x.text("resource_id").isNotNull() & x.text("charge_period_start").isNotNull()).withColumn("meter_name", F.coalesce(x.text("meter_name"), F.lit("")))


def load_cost(existing: DataFrame, lines: DataFrame, order: str) -> DataFrame:
    """The cost fact with a batch of lines merged in; the last line of a key counts."""
    key = ["cloud", "resource_id", "date_key", "meter_name"]
    return facts.upsert(existing, lines, key, facts.UPDATE_SETS["fact_resource_cost"], [order])


def load_credits(existing: DataFrame, mixed: DataFrame, order: str) -> DataFrame:
    """The credits fact with activity merged in, joined with what the last people row of each person says."""
    rows = facts.credits_with_people(mixed, order).withColumn("credits", x.safe_double("credits"))
    return facts.upsert(existing, rows, CREDIT_KEY, [c for c in existing.columns if c not in CREDIT_KEY], [order])


def catalogue_snapshot(items: DataFrame, captured: int) -> DataFrame:
    """What the catalogue says on a day, a row a package."""
    return items.select(F.lit(captured).alias("capture_date"), F.col("id").alias("package_id"), "display_name", "platform", "owner_id", F.coalesce("is_blocked", F.lit(False)).alias("is_blocked"))


def prototype_load(spans: DataFrame, agents: DataFrame, measures: list[str], order: str) -> tuple[DataFrame, DataFrame]:
    """The earlier loader's agents and consumption.

    An agent that spans name is made, the unattributed one too; there is no bridge, all counts as attributed, and a later row of
    an agent, measure, model and time replaces an earlier one.
    """
    rows = spans.withColumn("native_agent_id", F.coalesce(x.text("native_agent_id"), F.lit(facts.SENTINEL))).withColumn("model", or_unknown("model"))
    known = facts.with_keys(agents, rows, ["cloud", "native_agent_id"], "agent_key")
    keyed = rows.join(known, ["cloud", "native_agent_id"])
    long = keyed.select("agent_key", "model", "ts", order, *[F.col(m).cast("double").alias(m) for m in measures]).unpivot(["agent_key", "model", "ts", order], measures, "metric", "value").where("value IS NOT NULL")
    last = quality.keep_last(long, ["agent_key", "metric", "model", "ts"], [order]).drop(order)
    return known, last.withColumn("date_key", x.date_key("ts")).withColumn("attributed", F.lit(1))


def newest_by_run(rows: DataFrame, key: list[str], run: str, order: list[str]) -> DataFrame:
    """Dimension rows folded over runs: within a run the first row of a key counts, across runs each attribute's newest value that isn't null."""
    attributes = [c for c in rows.columns if c not in (*key, run, *order)]
    rank = F.row_number().over(Window.partitionBy(*key, run).orderBy(*order))
    first = rows.withColumn("_r", rank).where("_r = 1")
    return first.groupBy(*key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(run))).alias(c) for c in attributes])


#: Rows up to which a dimension is sent to all tasks.
FEW = 100_000


def few_first(dim: DataFrame) -> DataFrame:
    """A dimension, to be broadcast if it has few rows: then many facts share each of its keys and would sort in one task a key. Else its joins shuffle."""
    return F.broadcast(dim) if dim.limit(FEW + 1).count() <= FEW else dim


def bridge(rows: DataFrame, key: str, items: str, dim: DataFrame, dim_name: str, dim_key: str) -> DataFrame:
    """``key, dim_key, place``: a row for each distinct item of a row's list, at the place where it stands first."""
    listed = rows.select(key, F.posexplode(F.array_distinct(items)).alias("place", "_item"))
    named = listed.join(few_first(dim.select(F.col(dim_name).alias("_item"), dim_key)), "_item")
    return named.groupBy(key, dim_key).agg(F.min("place").alias("place"))


def with_blank(fact: DataFrame, dim: DataFrame, key: str, columns: list[str], measure: str) -> DataFrame:
    """A measure by columns of a dimension; facts without a partner are summed in a row of blanks. Facts are summed by key before they join."""
    sums = fact.groupBy(key).agg(F.sum(measure).alias(measure), F.count("*").alias("rows"))
    joined = sums.join(dim.select(key, *columns).dropDuplicates([key]), key, "left")
    return joined.groupBy(*columns).agg(F.sum(measure).alias(measure), F.sum("rows").alias("rows"))


def agent_alerts(card: DataFrame, usage: DataFrame, as_of: int, idle_days: int = 30, drop: float = 0.5) -> DataFrame:
    """``agent_key, alert``: idle agents, agents without an owner or type, and agents whose deferred events rise or whose use falls.

    ``card`` has ``agent_key, owner_id, agent_type, last_day``; ``usage`` has ``agent_key, date_key, events, deferred`` a day. Rises and
    falls compare the last seven days up to ``as_of`` with the seven before.
    """
    day = x.key_date("date_key")
    ago = F.datediff(x.key_date(F.lit(as_of)), day)
    recent = usage.where((ago >= 0) & (ago < 14)).groupBy("agent_key").agg(
        *[F.coalesce(F.sum(F.when(ago < 7, F.col(c))), F.lit(0)).alias(f"{c}_now") for c in ("events", "deferred")],
        *[F.coalesce(F.sum(F.when(ago >= 7, F.col(c))), F.lit(0)).alias(f"{c}_before") for c in ("events", "deferred")],
    )
    both = card.join(recent, "agent_key", "left")
    gap = F.datediff(x.key_date(F.lit(as_of)), x.key_date("last_day"))
    found = F.array_compact(
        F.array(
            F.when(F.col("last_day").isNull() | (gap > idle_days), F.lit("idle")),
            F.when(F.col("owner_id").isNull() | F.col("agent_type").isNull(), F.lit("metadata_gap")),
            F.when(F.col("deferred_now") > F.col("deferred_before"), F.lit("dlp_rising")),
            F.when(F.col("events_now") < drop * F.col("events_before"), F.lit("use_falling")),
        )
    )
    return both.select("agent_key", F.explode(found).alias("alert"))


def restated_at(existing: DataFrame, batch: DataFrame, key: list[str], day: str, as_of: int, days: int, ingested_at: Column) -> DataFrame:
    """A merge of the last ``days`` days before ``as_of``; rows that it writes say when (``ingested_at``)."""
    first = x.date_key(F.date_sub(x.key_date(F.lit(as_of)), days))
    inside = (F.col(day) >= first) & (F.col(day) < as_of)
    stamped = batch.where(inside).withColumn("ingested_at", ingested_at)
    update = [c for c in existing.columns if c not in key]
    return existing.where(~inside).unionByName(facts.upsert(existing.where(inside), stamped, key, update))


def rated(usage: DataFrame, rates: DataFrame, unit: str, day: str, quantity: str) -> DataFrame:
    """Usage in native units with the rate of its day: ``rates`` has the unit, ``valid_from``, ``valid_to`` (null is open) and ``unit_rate``.

    Usage is summed by unit and day before it meets the rates, which are curated and few. Usage without a rate keeps null costs.
    """
    sums = usage.groupBy(unit, day).agg(F.sum(quantity).alias(quantity))
    dated = rates.select(F.col(unit).alias("_unit"), "valid_from", "valid_to", "unit_rate")
    inside = (F.col(unit) == F.col("_unit")) & (F.col(day) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(day) < F.col("valid_to")))
    return sums.join(dated, inside, "left").select(unit, day, quantity, "unit_rate", (F.col(quantity) * F.col("unit_rate")).alias("cost"))

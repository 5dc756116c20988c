"""Keys, dimensions, tiered resolution, facts and keyed upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.functions import expressions as x
from fleetspark.operators.quality import keep_last
from fleetspark.sources.scratch import folder

SENTINEL = "(unattributed)"

# Which columns an upsert changes where the key exists; the others keep the value loaded first.
UPDATE_SETS = {
    "fact_agent_consumption": ["value", "attributed", "date_key", "resolution_tier"],
    "fact_agent_traces": ["agent_key", "resolution_tier", "caller_id", "total_tokens"],
    "fact_agent_audit": ["agent_key", "user_key", "resolution_tier"],
    "fact_resource_cost": ["billed_cost", "effective_cost", "consumed_quantity", "consumed_unit", "meter_category", "currency", "subscription_id", "resource_group"],
}


def first_agent_by_trace(spans: DataFrame, order: list[str] | None = None) -> DataFrame:
    """``trace_id, trace_agent``: the first id present in each trace, resolvable or not, in the order of columns such as file and row (by default, of span ids)."""
    return spans.where("trace_id IS NOT NULL AND native_agent_id IS NOT NULL").groupBy("trace_id").agg(F.min_by("native_agent_id", F.struct(*(order or ["span_id"]))).alias("trace_agent"))


def resolve(spans: DataFrame, agents: DataFrame, identity: DataFrame) -> DataFrame:
    """``spans`` with ``agent_key`` and ``resolution_tier``.

    In turn: the span's id through the identity bridge, the span's id in the catalogue, the trace's first id through
    either (correlation), else the sentinel of the span's cloud. Bridge and catalogue are one table by the id's base, so spans
    meet it once; traces are reduced to one row each before they meet their spans. Spans without an id, or without a trace, match
    nothing: their join keys are spread by the span's own id, so that they don't meet in one task.
    """
    bridge = identity.where("valid_to IS NULL").select(F.col("native_id").alias("_id"), F.col("agent_key").alias("_b"), F.lit(None).cast("long").alias("_n"))
    native = agents.where(F.col("native_agent_id") != SENTINEL).select(F.col("native_agent_id").alias("_id"), F.lit(None).cast("long").alias("_b"), F.col("agent_key").alias("_n"))
    known = bridge.unionByName(native).groupBy("_id").agg(F.min("_b").alias("_b"), F.min("_n").alias("_n")).where("_id IS NOT NULL")
    known = known.select(_key_of("_id").alias("_k"), "_b", "_n")
    sentinels = agents.where(F.col("native_agent_id") == SENTINEL).groupBy(F.col("cloud").alias("s_cloud")).agg(F.min("agent_key").alias("s_key"))

    first = first_agent_by_trace(spans).withColumn("_k", _key_of(x.identity_base("trace_agent")))
    traces = first.join(known, "_k").select(_key_of("trace_id").alias("_t"), F.coalesce("_b", "_n").alias("trace_key"))
    own = spans.withColumns({"_k": _key_of(x.identity_base("native_agent_id"), "span_id"), "_t": _key_of("trace_id", "span_id")})
    found = own.join(known, "_k", "left").join(traces, "_t", "left").join(F.broadcast(sentinels), F.col("cloud") == F.col("s_cloud"), "left")  # a row a cloud
    tier = F.when(F.col("_b").isNotNull(), "bridge").when(F.col("_n").isNotNull(), "native").when(F.col("trace_key").isNotNull(), "correlation").otherwise("unattributed")
    return found.withColumns({"agent_key": F.coalesce("_b", "_n", "trace_key", "s_key"), "resolution_tier": tier}).drop("_k", "_t", "_b", "_n", "trace_key", "s_cloud", "s_key")


def _key_of(value: str | Column, spread: str | None = None) -> Column:
    """A join key that is never null: the value behind an ``i``, or for null, which matches nothing, the hash of another column behind an ``n``."""
    value = F.col(value) if isinstance(value, str) else value
    there = F.concat(F.lit("i"), value.cast("string"))
    return F.coalesce(there, F.concat(F.lit("n"), F.xxhash64(spread).cast("string"))) if spread else there


def consumption(spans: DataFrame, measures: list[str]) -> DataFrame:
    """One row for each span and measure that is not null."""
    wide = spans.select("agent_key", "model_key", "date_key", "span_id", "resolution_tier", *[F.col(m).cast("double").alias(m) for m in measures])
    long = wide.unpivot(["agent_key", "model_key", "date_key", "span_id", "resolution_tier"], measures, "metric", "value")
    return long.where("value IS NOT NULL").withColumn("attributed", (F.col("resolution_tier") != "unattributed").cast("int"))


def audit_keys(audit: DataFrame, agents: DataFrame, cloud: str = "m365") -> DataFrame:
    """Audit events joined with the catalogue by native id; they never create agents, and what is unknown goes to the sentinel."""
    known = agents.where((F.col("cloud") == cloud) & (F.col("native_agent_id") != SENTINEL)).select(F.col("native_agent_id").alias("k_id"), F.col("agent_key").alias("k_key"))
    sentinel = agents.where((F.col("cloud") == cloud) & (F.col("native_agent_id") == SENTINEL)).agg(F.min("agent_key").alias("k_none"))
    joined = audit.join(known, F.col("native_agent_id") == F.col("k_id"), "left").crossJoin(F.broadcast(sentinel))  # one row
    tier = F.when(F.col("k_key").isNotNull(), "native").otherwise("unattributed")
    return joined.withColumn("agent_key", F.coalesce("k_key", "k_none")).withColumn("resolution_tier", tier).drop("k_id", "k_key", "k_none")


def snapshot(consumed: DataFrame) -> DataFrame:
    """Sum and count by agent, metric and day."""
    return consumed.groupBy("agent_key", "metric", "date_key").agg(F.sum("value").alias("value_sum"), F.count("*").alias("value_count"))


def upsert(existing: DataFrame, batch: DataFrame, key: list[str], update: list[str], order: list[str] | None = None) -> DataFrame:
    """``existing`` with ``batch`` merged in: new keys are added, of known keys only ``update`` columns change.

    With ``order`` the last row of a key within the batch counts. One full join on the key; key columns are not null.
    """
    return _merged(existing, keep_last(batch, key, order) if order else batch, key, update)


def _one_by_one(df: DataFrame, *columns: str | Column) -> DataFrame:
    """The columns through a generator, so that one which holds a constant stays a column. Two sides with different constants in a key would be folded
    to a join without any key, which compares all rows with all."""
    return df.select(F.explode(F.array(F.struct(*columns))).alias("_row_")).select("_row_.*")


def _merged(existing: DataFrame, new: DataFrame, key: list[str], update: list[str]) -> DataFrame:
    rest = [c for c in existing.columns if c not in key]
    old, fresh = _one_by_one(existing, *key, F.struct(*rest).alias("_o")), _one_by_one(new, *key, F.struct(*rest).alias("_n"))

    def value(c: str) -> Column:
        if c in update:
            return F.when(F.col("_n").isNotNull(), F.col(f"_n.{c}")).otherwise(F.col(f"_o.{c}"))
        return F.when(F.col("_o").isNotNull(), F.col(f"_o.{c}")).otherwise(F.col(f"_n.{c}"))

    joined = old.join(fresh, key, "full")
    return joined.select(*[F.col(c) if c in key else value(c).alias(c) for c in existing.columns])


def merge_newest(existing: DataFrame, batch: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Dimension merge: of a batch the first row of a key counts; across batches each attribute's newest value that isn't null."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    first = batch.withColumn("_r", rank).where("_r = 1").select(*existing.columns)
    both = _one_by_one(existing, *existing.columns).alias("o").join(_one_by_one(first, *existing.columns).alias("n"), key, "full")
    return both.select(*key, *[F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in existing.columns if c not in key])


def with_keys(existing: DataFrame, naturals: DataFrame, natural: list[str], key: str) -> DataFrame:
    """A key map with numbers for naturals that it lacks; numbers once given never change.

    New naturals are numbered by range: ranks are taken within the partitions of a range sort, stored, and shifted by the
    partitions' counts, so no task sees them all and ranks and counts are of one sort.
    """
    fresh = naturals.select(*natural).distinct().join(existing, natural, "left_anti")
    top = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("_top"))
    ranged = fresh.repartitionByRange(*natural).sortWithinPartitions(*natural).withColumn("_p", F.spark_partition_id())
    path = folder(fresh.sparkSession, "keys")
    ranged.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*natural))).write.parquet(path)
    ranked = fresh.sparkSession.read.parquet(path)
    sizes = ranked.groupBy("_p").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    numbered = ranked.join(F.broadcast(offsets), "_p").crossJoin(F.broadcast(top))  # a row a partition; one row
    return existing.select(*natural, key).unionByName(numbered.select(*natural, (F.col("_top") + F.col("_off") + F.col("_r")).cast("long").alias(key)))


def dim_date(days: Column, df: DataFrame) -> DataFrame:
    """The days that occur, with year, month and day."""
    return df.select(days.alias("date_key")).where("date_key IS NOT NULL").distinct().select(
        "date_key", F.call_function("div", F.col("date_key"), F.lit(10000)).cast("int").alias("year"), (F.call_function("div", F.col("date_key"), F.lit(100)) % 100).cast("int").alias("month"), (F.col("date_key") % 100).cast("int").alias("day")
    )


def fill_prompts(agents: DataFrame, details: DataFrame, cloud: str = "m365") -> DataFrame:
    """Instructions for agents of a cloud that have none, by native id."""
    known = details.groupBy(F.col("native_agent_id").alias("d_id")).agg(F.max("instructions").alias("d_text"))
    empty = (F.col("cloud") == cloud) & (F.col("instructions").isNull() | (F.col("instructions") == ""))
    return agents.join(known, F.col("native_agent_id") == F.col("d_id"), "left").withColumn("instructions", F.when(empty, F.coalesce("d_text", "instructions")).otherwise(F.col("instructions"))).drop("d_id", "d_text")


def credits_with_people(mixed: DataFrame, order: str) -> DataFrame:
    """Activity rows with what the last people row of each person says; unknown is empty."""
    people = keep_last(mixed.where("kind = 'people'"), ["person_id"], [order]).select("person_id", "organization", "licensed")
    activity = mixed.where("kind = 'activity'").drop("organization", "licensed", "kind")
    return activity.join(people, "person_id", "left").withColumn("organization", F.coalesce("organization", F.lit("")))


def agents_from_spans(spans: DataFrame, agents: DataFrame, cloud: str = "aws") -> DataFrame:
    """Agents of a cloud that only spans know: the service's name where there is one, else the id."""
    named = F.coalesce(F.nullif(F.col("service_name"), F.lit("")), F.col("native_agent_id"))
    seen = spans.where(F.col("cloud") == cloud).select(F.lit(cloud).alias("cloud"), named.alias("native_agent_id")).where("native_agent_id IS NOT NULL").distinct()
    return seen.join(agents.select("cloud", "native_agent_id"), ["cloud", "native_agent_id"], "left_anti")


def metric_consumption(metrics: DataFrame, agents: DataFrame) -> DataFrame:
    """Metric points on the sentinel of their cloud, not attributed."""
    sentinel = agents.where(F.col("native_agent_id") == SENTINEL).select("cloud", "agent_key")
    return metrics.join(sentinel, "cloud", "left").withColumn("attributed", F.lit(0)).withColumn("resolution_tier", F.lit("unattributed"))


def cost_fact(lines: DataFrame, order: str) -> DataFrame:
    """Cost lines by cloud, resource, day and meter: a missing meter is empty, the last line of a key counts, lines without a resource go."""
    rows = lines.where("resource_id IS NOT NULL").withColumn("meter_name", F.coalesce("meter_name", F.lit(""))).withColumn("cost_basis", F.lit("metered"))
    return keep_last(rows, ["cloud", "resource_id", "date_key", "meter_name"], [order])


def prototype_consumption(spans: DataFrame, measures: list[str]) -> DataFrame:
    """The earlier loader's reading: everything counts as attributed, on the sentinel too."""
    return consumption(spans, measures).withColumn("attributed", F.lit(1))


def prototype_agents(batch: DataFrame, order: list[str]) -> DataFrame:
    """The earlier loader's registry: rebuilt each time, the first row of an agent as it is."""
    rank = F.row_number().over(Window.partitionBy("cloud", "native_agent_id").orderBy(*order))
    return batch.withColumn("_r", rank).where("_r = 1").drop("_r")


def restated(existing: DataFrame, batch: DataFrame, key: list[str], day: str, first: int, last: int) -> DataFrame:
    """A merge bounded to the days [first, last]: rows of other days are neither joined nor changed."""
    inside = F.col(day).between(first, last)
    update = [c for c in existing.columns if c not in key]
    return existing.where(~inside).unionByName(upsert(existing.where(inside), batch.where(inside), key, update))

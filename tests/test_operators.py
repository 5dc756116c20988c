from datetime import date

from pyspark.sql import functions as F

from fleetspark.functions import expressions as x
from fleetspark.operators import facts, flatten, quality
from fleetspark.plans import measures, views
from fleetspark.sources import landing, pipelines


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def test_text_strips_unicode_space_and_empties(spark):
    assert one(spark, x.text(F.lit("　 a b\t"))) == "a b"
    assert one(spark, x.text(F.lit("  "))) is None
    assert one(spark, x.hash16(F.lit(" abc "))) == "ba7816bf8f01cfea"


def test_dates(spark):
    assert one(spark, x.dotnet_date(F.lit("/Date(0)/"))) == "1970-01-01T00:00:00Z"
    assert one(spark, x.dotnet_date(F.lit("/Date(99999999999999999)/"))) is None
    assert one(spark, x.dotnet_date(F.lit("2024-01-01"))) == "2024-01-01"
    assert one(spark, x.date_key(F.lit("2024-02-30T00:00:00"))) is None
    assert one(spark, x.date_key(F.lit("2024-02-29T23:59:59+05:00"))) == 20240229
    assert one(spark, x.nanos_iso(F.lit("1000"))) == "1970-01-01T00:00:00.000001Z"


def test_identifiers(spark):
    assert one(spark, x.identity_base(F.lit("a:b:15"))) == "a:b"
    assert one(spark, x.id_head(F.lit("a:b:15"))) == "a"
    assert one(spark, x.id_head(F.lit(None).cast("string"))) == ""
    assert one(spark, x.model_cloud(F.lit("EU.amazon.x"), F.lit("azure"))) == "aws"
    assert one(spark, x.model_cloud(F.lit("gpt"), F.lit("azure"))) == "azure"
    assert one(spark, x.signal_class(F.lit("deadbeef-0a1b-4c"))) == "guid_only"
    assert one(spark, x.connector_service(F.lit("Office 365 Outlook Send an email"))) == "Office 365 Outlook"
    assert one(spark, x.resource_part(F.lit("/Subscriptions/S/ResourceGroups/G/x"), "resourcegroups")) == "G"


def test_drift_object_of_bad_json_is_empty(spark):
    assert one(spark, F.to_json(x.drift_object(F.lit("{bad")))) == "{}"
    assert one(spark, F.to_json(x.drift_object(F.lit("[1]")))) == "{}"
    assert one(spark, x.first_of_list(F.lit('["a","b"]'))) == "a"


def test_first_and_last(spark):
    rows = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), (None, 3, "c"), (None, 4, "d")], "id string, seq int, v string")
    assert {r["v"] for r in quality.keep_first(rows, ["id"], ["seq"]).collect()} == {"a", "c"}
    assert {r["v"] for r in quality.keep_last(rows, ["id"], ["seq"]).collect()} == {"b", "d"}


def test_a_dedup_key_reads_null_as_none(spark):
    rows = spark.createDataFrame([(None, "t"), ("None", "t")], "id string, at string")
    assert rows.select(quality.dedup_key(["id", "at"]).alias("k")).distinct().count() == 1


def test_orphans_pass_null_if_optional(spark):
    child, parent = spark.createDataFrame([(1,), (None,), (3,)], "k int"), spark.createDataFrame([(1,)], "p int")
    got = {r["check_name"]: r["orphans"] for r in quality.orphans([("a", child, "k", parent, "p", True), ("b", child, "k", parent, "p", False)]).collect()}
    assert got == {"a": 1, "b": 2}


def test_ghosts_match_null_names(spark):
    rows = spark.createDataFrame([(1, None, "p", "0"), (2, None, "p", "me"), (3, "x", "p", "0")], "id int, display_name string, platform string, owner_id string")
    assert {r["id"] for r in quality.ghosts_dropped(rows, "0").collect()} == {2, 3}


def test_upsert_changes_only_its_columns_and_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", None)], "id int, status string, tokens int")
    new = spark.createDataFrame([(1, "late", None, 1), (1, "later", 7, 2), (3, "c", 5, 1)], "id int, status string, tokens int, seq int")
    once = facts.upsert(old, new, ["id"], ["tokens"], ["seq"])
    want = {(1, "a", 7), (2, "b", None), (3, "c", 5)}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in facts.upsert(once, new, ["id"], ["tokens"], ["seq"]).collect()} == want


def test_keys_are_stable(spark):
    a = spark.createDataFrame([("x",), ("y",)], "n string")
    none = spark.createDataFrame([], "n string, key long")
    first = facts.with_keys(none, a, ["n"], "key")
    second = facts.with_keys(first, spark.createDataFrame([("a",), ("x",), ("z",)], "n string"), ["n"], "key")
    before, after = ({r["n"]: r["key"] for r in d.collect()} for d in (first, second))
    assert before.items() <= after.items() and sorted(after.values()) == [1, 2, 3, 4]


def test_resolution_tiers(spark):
    agents = spark.createDataFrame([(1, "azure", "n1"), (2, "azure", "n2"), (-2, "azure", "(unattributed)")], "agent_key long, cloud string, native_agent_id string")
    identity = spark.createDataFrame([(2, "b1", None), (1, "b2", date(2024, 1, 1))], "agent_key long, native_id string, valid_to date")
    spans = spark.createDataFrame([(1, 1, "azure", "b1:3"), (1, 2, "azure", None), (2, 3, "azure", "n1"), (3, 4, "azure", "b2:1"), (4, 5, "azure", "zz"), (4, 6, "azure", "n1")], "trace_id long, span_id long, cloud string, native_agent_id string")
    got = {r["span_id"]: (r["agent_key"], r["resolution_tier"]) for r in facts.resolve(spans, agents, identity).collect()}
    # trace 4's first id can't be resolved, so its first span stays unattributed
    assert got == {1: (2, "bridge"), 2: (2, "correlation"), 3: (1, "native"), 4: (-2, "unattributed"), 5: (-2, "unattributed"), 6: (1, "native")}


def test_spans_without_an_id_or_a_trace(spark):
    agents = spark.createDataFrame([(1, "azure", "n1"), (2, "aws", "n1"), (-2, "azure", "(unattributed)"), (-1, "aws", "(unattributed)")], "agent_key long, cloud string, native_agent_id string")
    identity = spark.createDataFrame([(3, None, None), (5, "n1", None), (4, "n1", None)], "agent_key long, native_id string, valid_to date")
    rows = [(None, 1, "azure", None), (None, 2, "aws", "n1"), (7, 3, "aws", None), (7, None, "aws", None), (7, 4, "azure", "n1:2"), (8, 5, "other", None)]
    spans = spark.createDataFrame(rows, "trace_id long, span_id long, cloud string, native_agent_id string")
    found = facts.resolve(spans, agents, identity)
    assert found.columns == [*spans.columns, "agent_key", "resolution_tier"]
    got = sorted((r["span_id"] or 0, r["agent_key"], r["resolution_tier"]) for r in found.collect())
    # of two bridged keys the least; a cloud without a sentinel has no key
    assert got == [(0, 4, "correlation"), (1, -2, "unattributed"), (2, 4, "bridge"), (3, 4, "correlation"), (4, 4, "bridge"), (5, None, "unattributed")]
    none = facts.resolve(spans.limit(0), agents, identity)
    assert none.count() == 0


def test_orphans_by_counted_rows(spark):
    child = spark.createDataFrame([(1, 2), (9, 3), (None, 4), (9, 1)], "k long, c long")
    parent = spark.createDataFrame([(1,)], "p long")
    checks = [("needed", child, "k", parent, "p", False), ("optional", child, "k", parent, "p", True)]
    assert {tuple(r) for r in quality.orphans(checks, "c").collect()} == {("needed", 8), ("optional", 4)}
    assert {tuple(r) for r in quality.orphans(checks).collect()} == {("needed", 3), ("optional", 2)}
    assert {tuple(r) for r in quality.orphans([("none", child.limit(0), "k", parent, "p", False)]).collect()} == {("none", 0)}


def test_allocation_ties_to_cost_within_rounding(spark, sf_dir):
    from fleetspark.plans.bind import bound
    from fleetspark.plans.catalog import allocation_of

    total = allocation_of(spark, sf_dir).agg(F.sum("allocated_cost")).first()[0]
    cost = bound(spark, sf_dir, "b_cost").agg(F.sum(x.effective_cost())).first()[0]
    assert abs(float(total) - float(cost)) < 1e-3


def test_null_type_pattern_is_a_sentinel(spark):
    agents = spark.createDataFrame([(1, "aws", None), (2, "aws", "x"), (3, "m365", "App for Teams"), (4, "m365", "odd")], "agent_key long, cloud string, agent_type string")
    got = {r["agent_key"]: r["cost_method"] for r in views.cost_methods(agents, views.method_map(spark)).collect()}
    assert got == {1: "metered_allocated", 2: "metered_allocated", 3: "bundled_zero", 4: "credit_rated"}


def test_previous_business_day(spark):
    days = spark.createDataFrame([(date(2026, 6, 18),), (date(2026, 6, 22),), (date(2026, 6, 21),)], "day date")
    got = {r["day"]: r["previous"] for r in measures.previous_business_day(days, []).collect()}
    assert got == {"2026-06-18": "2026-06-17", "2026-06-22": "2026-06-19", "2026-06-21": "2026-06-19"}
    assert measures.previous_business_day(days.limit(1), ["2026-06-17"]).first()["previous"] == "2026-06-16"


REGISTRY = [
    '[{"package_id":"a","agent_type":"sharepoint","last_modified":"1","tenantRegion":"eu"},{"package_id":"b","agent_type":"copilot_studio","last_modified":"1","connectors":["x"]}]',
    '[{"package_id":"a","agent_type":"sharepoint","last_modified":"1"},{"package_id":null,"agent_type":"sharepoint"},{"package_id":"c","agent_type":"agent_builder","enabled":true},{"package_id":"d","agent_type":"custom_engine"}]',
]


def test_a_source_from_pages_to_counts(spark, tmp_path):
    for i, page in enumerate(REGISTRY):
        (tmp_path / f"page_{i}.json").write_text(page)
    pages = landing.json_pages(spark, str(tmp_path))
    valid, quarantine, stats = pipelines.run(pages, pipelines.SOURCES["m365_registry"])
    assert tuple(stats.select("kept", "duplicates", "invalid", "drifted").first()) == (4, 1, 1, 1)
    assert valid.where("_drift IS NOT NULL").first()["_drift"] == '{"tenantRegion":"eu"}'
    assert {r["connectors"] for r in valid.collect()} == {None, '["x"]'}
    assert quarantine.first()["error"] == "package_id: required"


def test_enum_and_type_errors_go_to_quarantine(spark):
    raw = ['{"package_id":"a","agent_type":"other"}', '{"package_id":"a","agent_type":"sharepoint","enabled":"maybe"}', "{bad"]
    pages = spark.createDataFrame([(r, "f", i) for i, r in enumerate(raw)], "raw string, _file string, _row int")
    _, quarantine, stats = pipelines.run(pages, pipelines.SOURCES["m365_registry"])
    assert sorted(r["error"] for r in quarantine.collect()) == ["agent_type: not allowed", "enabled: not boolean", "not an object"]
    assert stats.first()["kept"] == 0


def test_every_source_has_its_key(spark):
    for source in pipelines.SOURCES.values():
        names = [f.name for f in source.schema]
        assert set(source.required) | set(source.key) <= set(names)
    assert len(pipelines.SOURCES) == 12


def test_json_page_may_be_one_object_or_an_envelope(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"value":[{"id":"1"},{"id":"2"}]}')
    raw = spark.read.text(str(tmp_path), wholetext=True).withColumnRenamed("value", "raw")
    assert [r["i"] for r in flatten.envelope(raw).select(flatten.got("doc", "$.id").alias("i")).collect()] == ["1", "2"]
    assert landing.json_pages(spark, str(tmp_path)).count() == 1


def test_versions_and_cursor(spark, tmp_path):
    t = landing.Table(spark, str(tmp_path / "t"))
    assert t.read() is None
    t.replace(spark.range(2))
    old = t.read()
    t.replace(spark.range(5))
    assert (old.count(), t.read().count()) == (2, 5)
    path = str(tmp_path / "state")
    assert landing.read_cursor(spark, path, "s") is None
    landing.advance_cursor(spark, path, "s", "2024-01-02", 1)
    assert landing.read_cursor(spark, path, "s") == "2024-01-02"


def test_missing_rate_drops_the_week_and_zero_total_allocates_nothing(spark):
    spans = spark.createDataFrame([(1, "azure", "m", 0, "chat", "native", 20240101)], "agent_key long, cloud string, model_key string, total_tokens long, operation_name string, resolution_tier string, date_key int")
    cost = spark.createDataFrame([("azure", 20240101, "5.00", None, "EUR")], "cloud string, date_key int, billed_cost string, effective_cost string, currency string")
    got = {(r["cost_basis"], float(r["allocated_cost"])) for r in views.cost_allocation(spans, cost.withColumn("billed_cost", F.col("billed_cost").cast("decimal(18,2)")).withColumn("effective_cost", F.lit(None).cast("decimal(18,2)"))).collect()}
    assert got == {("allocated", 0.0), ("unallocated", 5.0)}


def test_gaps_end_a_rising_run_and_long_rates_overlap_later_ones(spark):
    from datetime import date

    from fleetspark.operators import trends

    days = spark.createDataFrame([("a", date(2024, 1, d), n) for d, n in ((1, 1), (2, 2), (3, 3), (5, 4), (6, 5), (7, 9))] + [("b", date(2024, 1, 1), 5)], "k string, day date, n int")
    got = {(r["first_day"].day, r["last_day"].day, r["steps"], r["gained"]) for r in trends.rising_runs(days, "k", "day", "n", 2).collect()}
    assert got == {(2, 3, 2, 2), (5, 7, 3, 9)}
    rates = spark.createDataFrame([("x", 1, date(2024, 1, 1), None), ("x", 2, date(2024, 2, 1), date(2024, 3, 1)), ("x", 3, date(2024, 6, 1), date(2024, 6, 1)), ("y", 4, date(2024, 1, 1), date(2024, 2, 1)), ("y", 5, date(2024, 2, 1), None)], "unit string, rate_id int, valid_from date, valid_to date")
    assert [r["rate_id"] for r in trends.overlapping_rates(rates, ["unit"]).collect()] == [2]


def test_lines_of_a_part_keep_their_order(spark, tmp_path):
    from fleetspark.sources import landing

    (tmp_path / "a.json").write_text('{"k":1}\n\n{"k":1,"v":"later"}\r\n{"k":2}\n')
    got = [(r["_row"], r["raw"]) for r in landing.ndjson_parts(spark, str(tmp_path / "*.json")).orderBy("_row").collect()]
    assert got == [(0, '{"k":1}'), (2, '{"k":1,"v":"later"}'), (3, '{"k":2}')]

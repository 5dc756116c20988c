import json

import pytest

from fleetspark.plans import registry
from fleetspark.sources import pipelines


def test_every_source_is_a_query():
    names = registry.queries()
    assert all(f"source_{s}" in names for s in pipelines.SOURCES if s != "m365_usage") and "source_usage" in names


def test_payloads_are_flattened_or_quarantined_whole(spark):
    bucket = {"TimePeriod": {"Start": "d"}, "Groups": [{"Keys": ["u", "o"], "Metrics": {}}, {"Keys": ["u", "o"], "Metrics": {}}, {"Keys": ["v"], "Metrics": {}}]}
    raw = [json.dumps(bucket), json.dumps({"Groups": "none"}), "{bad", json.dumps({"time_period_start": "flat"})]
    pages = spark.createDataFrame([(r, "f", i) for i, r in enumerate(raw)], "raw string, _file string, _row int")
    valid, quarantine, stats = pipelines.run(pages, pipelines.SOURCES["bedrock_cost"])
    assert sorted((r["time_period_start"], r["usage_type"] or "") for r in valid.collect()) == [("d", "u"), ("d", "v"), ("flat", "")]
    assert sorted(r["raw"] for r in quarantine.collect()) == sorted(raw[1:3])
    assert tuple(stats.select("kept", "duplicates", "invalid").first()) == (3, 1, 2)


def test_pages_are_scanned_once(spark, tmp_path):
    """One scan in the plan of the parsed rows, for a source of two steps, and results by Observation; no page gives zeros."""
    names = '{"name":"Id"},{"name":"Properties"}'
    page = f'{{"tables":[{{"columns":[{names}],"rows":[["s1","{{\\"gen_ai.system\\":\\"x\\"}}"],["s2",null]]}}]}}'
    rows = [(page, "f", 0), ("{bad", "f", 1), ('{"span_id":"s3","x":1}', "f", 2), ('{"span_id":"s3"}', "f", 3), (None, "f", 4)]
    spark.createDataFrame(rows, "raw string, _file string, _row long").write.parquet(str(tmp_path / "pages"))
    pages = spark.read.parquet(str(tmp_path / "pages"))
    source = pipelines.SOURCES["foundry_traces"]
    plan = pipelines.records(pages, source)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    valid, rejected, stats = pipelines.run(pages, source)
    assert sorted(r["span_id"] for r in valid.collect()) == ["s1", "s3"]
    assert sorted(str(r["raw"]) for r in rejected.collect()) == ["None", "{bad"]
    assert stats.first().asDict() == {"kept": 2, "duplicates": 1, "invalid": 2, "drifted": 1}
    assert pipelines.run(pages.where("false"), source)[2].first().asDict() == {"kept": 0, "duplicates": 0, "invalid": 0, "drifted": 0}


def test_a_span_in_snake_case_is_no_record(spark):
    rows = [('{"span_id":"s1","trace_id":"t1","name":"n"}', "f", 0), ('{"span_id":"s2","timestamp":"t","extra":1}', "f", 1)]
    valid, _, _ = pipelines.run(spark.createDataFrame(rows, "raw string, _file string, _row long"), pipelines.SOURCES["bedrock_traces"])
    got = {r["span_id"]: r for r in valid.collect()}
    assert got["s1"]["trace_id"] == "t1" and '"span_name":"n"' in got["s1"]["_drift"] and got["s2"]["timestamp"] == "t" and got["s2"]["_drift"] == '{"extra":"1"}'


@pytest.mark.parametrize("source", ["bedrock_traces", "foundry_traces", "purview_audit"])
def test_payloads_are_parsed_behind_their_shuffle(spark, source):
    """No filter that parses is moved in front of the shuffle that deals pages out, and a step doesn't repeat its parse for each value it reads."""
    pages = spark.createDataFrame([("{}", "f", 0)], "raw string, _file string, _row long")
    plan = pipelines.records(pages, pipelines.SOURCES[source])._jdf.queryExecution().optimizedPlan().toString()
    above, dealt, below = plan.partition("RepartitionByExpression")
    assert dealt and "parse" not in below.lower()
    assert above.lower().count("parsejson") + above.lower().count("parse_json") <= 6


def test_a_span_is_parsed_once_and_missing_keys_are_no_paths(spark):
    """A path that isn't there costs an exception in each row; the members of a span are looked up in a map instead, and its columns are told by key."""
    pages = spark.createDataFrame([("{}", "f", 0)], "raw string, _file string, _row long")
    plan = pipelines.records(pages, pipelines.SOURCES["bedrock_traces"])._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parsejson(") == 1
    assert not [k for k in ("$.timestamp", "$.token_count", "$.span_id", "$.durationnano", "$['service.name']") if k in plan]


def test_repeated_keys_keep_the_first_value(spark):
    rows = [('{"span_id":"a","span_id":"b","timestamp":"t","k":1,"k":2}', "f", 0), ('\n\t {"span_id":"c","timestamp":"t"}', "f", 1), ('[{"span_id":"d"}]', "f", 2)]
    valid, wrong, _ = pipelines.run(spark.createDataFrame(rows, "raw string, _file string, _row long"), pipelines.SOURCES["bedrock_traces"])
    assert {(r["span_id"], r["_drift"]) for r in valid.collect()} == {("a", '{"k":"1"}'), ("c", None)}
    assert [r["error"] for r in wrong.collect()] == ["not an object"]

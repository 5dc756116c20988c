"""Work that is dealt out evenly although files are small or keys are hot."""

import pytest

from fleetspark.operators import flatten, star
from fleetspark.sources import pipelines


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled_joins(spark):
    """Joins as over tables whose size keeps Spark from a broadcast of its own."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_catalogue_pages_are_dealt_out_before_they_are_parsed(spark):
    pages = spark.range(8).selectExpr("""concat('{"id":"p', id, '","displayName":"n"}') AS raw""").coalesce(1)
    found = flatten.agent_details(pages)
    assert "hashpartitioning(raw" in plan_of(found)
    assert sorted(r["native_agent_id"] for r in found.collect()) == [f"p{i}" for i in range(8)]


def test_source_pages_are_dealt_out_before_they_are_parsed(spark):
    pages = spark.range(8).selectExpr("""concat('{"time_period_start":"d', id, '"}') AS raw""", "'f' AS _file", "id AS _row").coalesce(1)
    found = pipelines.records(pages, pipelines.SOURCES["bedrock_cost"])
    assert "REPARTITION_BY_COL" in plan_of(found)
    assert sorted((r["_row"], r["raw"]) for r in found.collect()) == [(i, f'{{"time_period_start":"d{i}"}}') for i in range(8)]


def test_points_of_one_query_do_not_meet_in_one_task(spark, shuffled_joins):
    pages = spark.createDataFrame([('{"Id":"q","Timestamps":["a","b"],"Values":[1,2,3]}',), ('{"Id":"z","Timestamps":["a"],"Values":[1]}',)], "raw string")
    points = flatten.metric_arrays(pages, spark.createDataFrame([("q", "Invocations", "m")], "id string, metric_name string, model_id string"))
    assert "SortMergeJoin" not in plan_of(points)
    assert sorted((r["timestamp"], r["value"], r["metric_name"]) for r in points.collect()) == [("a", 1.0, "Invocations"), ("b", 2.0, "Invocations")]


def test_rows_of_one_connector_do_not_meet_in_one_task(spark, shuffled_joins, monkeypatch):
    rows = spark.createDataFrame([(1, ["Jira", "Mail", "Jira"]), (2, ["Mail"])], "agent long, names array<string>")
    dim = spark.createDataFrame([("Jira", 7), ("Mail", 8)], "name string, key long")
    few = star.bridge(rows, "agent", "names", dim, "name", "key")
    monkeypatch.setattr(star, "FEW", 1)
    many = star.bridge(rows, "agent", "names", dim, "name", "key")
    assert "SortMergeJoin" not in plan_of(few) and "SortMergeJoin" in plan_of(many)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) == [(1, 7, 0), (1, 8, 1), (2, 8, 0)]

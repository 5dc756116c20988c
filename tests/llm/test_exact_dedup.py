import pytest

from fleetspark.llm import exact_dedup
from fleetspark.llm.queries import oracle_sql, queries
from tests.oracle import connect, differences

ROWS = [(1, "a", 1), (2, "a", 1), (3, None, 1), (4, "", 1), (5, "b", 1), (5, "b", 1), (None, "b", 1), (None, "c", 1), (6, "x" * 5000 + "1", 1), (7, "x" * 5000 + "2", 1), (8, "x" * 5000 + "1", 1)]


@pytest.mark.parametrize("few", [1 << 25, 0])
def test_groups(spark, few):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, kept int")
    got = exact_dedup.exact_groups(docs, broadcast_bytes=few)
    rows = sorted(((str(r["doc_id"]), r["keep_id"], r["group_size"], r["kept"]) for r in got.collect()), key=str)
    assert rows == sorted([("1", 2, 2, False), ("2", 2, 2, True), ("3", 4, 2, False), ("4", 4, 2, True), ("5", 5, 3, True), ("5", 5, 3, True), ("None", 5, 3, False), ("None", None, 1, True), ("6", 8, 2, False), ("7", 7, 1, True), ("8", 8, 2, True)], key=str)


def test_one_row_of_each_text_stays(spark):
    docs = spark.createDataFrame(ROWS + [(None, "d", 1), (None, "d", 1)], "doc_id long, text string, keep_id int")
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "4", "5", "7", "8", "None", "None"]
    assert exact_dedup.drop_exact_duplicates(docs.limit(0)).count() == 0


def test_no_python_runs(spark, sf_dir):
    plan = queries()["op8_exact_dedup"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["op8_exact_dedup", "op5_warc"])
def test_queries_match_their_sql(spark, sf_dir, name):
    assert differences(queries()[name](spark, sf_dir), connect(sf_dir).sql(oracle_sql()[name])) == []

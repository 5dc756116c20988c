"""What showed only on larger tables than the fixtures."""

from fleetspark.operators import facts


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merges_of_different_constants_join_by_key(spark):
    """A key column that is a constant on either side is not folded out of the join, which then would compare all rows with all."""
    rows = spark.range(50).selectExpr("id", "concat('n', id) AS name")
    old, new = rows.selectExpr("1 AS day", "id", "name"), rows.where("id % 2 = 0").selectExpr("2 AS day", "id", "upper(name) AS name")
    for merged in (facts.upsert(old, new, ["day", "id"], ["name"]), facts.merge_newest(old.withColumn("o", old.id), new.withColumn("o", new.id), ["day", "id"], ["o"])):
        assert "NestedLoop" not in plan_of(merged)
        got = {(r["day"], r["id"]): r["name"] for r in merged.collect()}
        assert got == {(1, i): f"n{i}" for i in range(50)} | {(2, i): f"N{i}" for i in range(0, 50, 2)}

import random

import duckdb

from fleetspark.functions import expressions as x


def test_large_amounts_round_as_in_sql(spark):
    """Amounts of hundreds of millions and more, whose doubles are about as far apart as the last place."""
    rng = random.Random(3)
    amounts = [(i, rng.choice((-1, 1)) * rng.random() * 10 ** rng.randint(-6, 12)) for i in range(4000)] + [(9000, 0.0000005), (9001, -2.5e-6), (9002, 0.0)]
    got = {r["i"]: str(r["v"]) for r in spark.createDataFrame(amounts, "i int, a double").select("i", x.millionths("a").alias("v")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE amounts AS SELECT unnest(?) AS i, unnest(?) AS a", [[i for i, _ in amounts], [a for _, a in amounts]])
    want = dict(con.execute("SELECT i, CAST(CAST(round(a, 6) AS DECIMAL(38, 6)) AS VARCHAR) FROM amounts").fetchall())
    number = lambda v: int(v.replace(".", "")) if "E" not in v else round(float(v) * 1e6)
    assert {i: number(v) for i, v in got.items()} == {i: number(v) for i, v in want.items()}
    far = spark.sql("SELECT 1.5e15D AS a").select(x.millionths("a").alias("v")).first()["v"]
    assert far == 1_500_000_000_000_000

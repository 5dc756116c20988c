import re

from pyspark.sql import functions as F

from fleetspark.functions import expressions as x

# What Unicode calls white space, beside characters that only look like it.
WHITE, OTHER = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], [0x1C, 0x1F, 0x180E, 0x200B, 0x2060, 0xFEFF]


def test_strip_takes_white_space_from_both_ends_only(spark):
    rows = [(chr(c) + mid + chr(c) * 2,) for c in WHITE + OTHER for mid in ("", "a", f"é{chr(c)}\n b")]
    got = spark.createDataFrame(rows, "t string").select("t", x.strip("t").alias("s"), F.regexp_replace("t", r"(?U)^\s+|\s+$", "").alias("r"))
    white = re.escape("".join(map(chr, WHITE)))
    for r in got.collect():
        assert r["s"] == r["r"] == re.sub(f"^[{white}]+|[{white}]+\\Z", "", r["t"])
    assert "regexp" not in got.select("s")._jdf.queryExecution().optimizedPlan().toString().lower()


def test_drift_is_an_object_or_empty(spark):
    texts = [' \n{"a":1}', "[1]", '"{"', "{bad", "null", "", None, "{}"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(F.to_json(x.drift_object("t")).alias("o")).collect()
    assert [r["o"] for r in got] == ['{"a":1}'] + ["{}"] * 7


def test_a_failed_status_is_told_in_any_case(spark):
    said = {"ERROR": "ERROR", "error": "ERROR", "Status_Code_Error": "ERROR", "ﬆatus_code_error": "ERROR", "ERROR\n": None, "STATUS_ERROR": None, "": None, None: None}
    nothing = F.lit(None).cast("string")
    df = spark.createDataFrame([(s,) for s in said], "s string")
    got = df.select("s", x.span_error(F.col("s"), nothing, F.lit(None).cast("bigint"), nothing).alias("e"))
    assert {r["s"]: r["e"] for r in got.collect()} == said

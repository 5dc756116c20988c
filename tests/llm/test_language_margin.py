import random

from pyspark.sql import functions as F

from fleetspark.llm import language_id

SF = "/root/testdata/sf0.01"


def test_narrow_margins_are_rejected(spark):
    """Letter junk, texts of a language that was not learned and halves of two languages; clean rows beside them stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 1000").select("doc_id", "text", "lang")
    learnt = docs.where("lang <> 'fr'")
    rng = random.Random(5)
    junk = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(300)) for _ in range(50)]
    by = {r["lang"]: r["t"] for r in docs.groupBy("lang").agg(F.sort_array(F.collect_list(F.left("text", F.lit(1000)))).alias("t")).collect()}
    halves = [a + " " + b for a, b in zip(by["en"], by["de"])][:50]
    planted = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(junk + halves)], learnt.schema)
    found = language_id.label(learnt.unionByName(docs.where("lang = 'fr'").withColumn("lang", F.lit(None).cast("string"))).unionByName(planted))
    kind = F.when(F.col("doc_id") < -50, "halves").when(F.col("doc_id") < 0, "junk").when(F.col("lang").isNull(), "foreign").otherwise("clean")
    got = {r["kind"]: r["share"] for r in found.groupBy(kind.alias("kind")).agg(F.avg(F.col("__li.rejected").cast("int")).alias("share")).collect()}
    assert got["junk"] > 0.9 and got["foreign"] > 0.9 and got["halves"] > 0.6 and got["clean"] < 0.02, got

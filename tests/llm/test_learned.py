import collections

import numpy as np
import zstandard
from pyspark.sql import functions as F

from fleetspark.llm import language_id, toxicity
from fleetspark.llm.common import least_hashed, within
from fleetspark.llm.queries import queries

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = queries()["op1_language_id"](spark, SF).join(docs, "doc_id")
    right, rows, rejected = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.sum(F.col("rejected").cast("int"))).first()
    assert rows > 200 and right > 0.95 and rejected <= 3


def test_language_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en", 1), (2, "der hund und die katze", "de", 1), (3, None, "en", 1), (4, "12 34!", "en", 1), (5, "the dog", None, 1), (6, "the " * 50_000, "en", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = {r["doc_id"]: r["__li"] for r in language_id.label(docs).collect()}
    assert got[3]["lang_pred"] == got[4]["lang_pred"] == "und" and got[3]["score"] == 0 and got[4]["rejected"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language_id.label(docs.limit(0)).count() == 0
    unlabelled = language_id.label(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["__li"]["lang_pred"] for r in unlabelled} == {"und"}


def test_letters_are_letters():
    assert language_id.letters("½ ² Ⅷ 12 _!") == b"" == language_id.letters(None) == language_id.letters("")
    assert language_id.letters("Ça va, हिन्दी 42x") == "ça va हिन्दी x".encode()  # marks stay with their letters


def test_one_text_against_each_dictionary():
    """Sizes and choices as zstandard gives them for the whole text, piece by piece."""
    dictionaries = {"de": b"der hund und die katze " * 20, "en": b"the cat and the dog " * 20}
    judge = language_id.Identifier(dictionaries)
    for text in ["the dog", "die katze", "the cat and the dog " * 80, "und", "der hund " * 300 + "the"]:
        data = language_id.letters(text)
        count = -(-len(data) // 512)
        step = -(-len(data) // count)
        sizes = {}
        for lang, known in dictionaries.items():
            whole = zstandard.ZstdCompressor(level=6, dict_data=zstandard.ZstdCompressionDict(known, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes[lang] = sum(len(whole.compress(b" ".join([data[i : i + step]] * 6))) for i in range(0, len(data), step))
        lang, score, _ = judge(text)
        best, other = sorted(sizes.values())
        if best < other:
            assert (lang, score) == (min(sizes, key=sizes.get), (other - best) / other)


def test_language_ties_copies_and_null_ids(spark):
    same = language_id.Identifier({"aa": b"some words of one kind", "bb": b"some words of one kind"})
    assert same("some words of one kind") == ("aa", 0.0, True)
    rows = [(1, "the cat and the dog", "en"), (1, "the cat and the dog", "en"), (None, "the cat and the dog", "en"), (None, "der hund und die katze", "de"), (3, "½ ²", "de")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, lang_pred string, __rank int")
    got = [(r["doc_id"], r["__li"]["lang_pred"], r["lang_pred"]) for r in language_id.label(docs).collect()]
    assert collections.Counter(got) == {(1, "en", "x"): 2, (None, "en", "x"): 1, (None, "de", "x"): 1, (3, "und", "x"): 1}
    long = language_id.Identifier(language_id.fit(docs))("the cat and the dog " * 200_000)
    assert long[0] == "en"


def test_samples_are_bounded_and_the_same_wherever_rows_lie(spark):
    rows = spark.range(20_000).selectExpr("if(id % 50 = 0, 'few', 'hot') AS label", "xxhash64(id) AS at", "id")
    found = [sorted(map(tuple, least_hashed(rows.repartition(n), "label", "at", 300).collect())) for n in (2, 7)]
    assert found[0] == found[1] and collections.Counter(r[0] for r in found[0]) == {"few": 300, "hot": 300}
    assert within([("a", 5, 1), ("a", 6, 2), ("a", 4, 3), ("b", 10, 4)], 10) == [("a", 5, 1), ("a", 4, 3), ("b", 10, 4)]


def test_toxicity_held_out(spark):
    got = queries()["op3_toxicity"](spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out")
    counts = ["toxic = 1 AND predicted = 1", "toxic = 0 AND predicted = 1", "toxic = 1", "toxic = 0"]
    hit, false, toxic, clean = got.agg(*[F.count_if(F.expr(c)) for c in counts]).first()
    assert toxic > 50 and hit / toxic >= 0.9 and false / clean <= 0.05, (hit, false, toxic, clean)


def test_offending_sentences_are_found(spark):
    clean = [f"calm words number {i}. They are friendly here. Rain fell." for i in range(300)]
    bad = [f"calm words number {i}. You horrid pest. Rain fell." for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(clean + bad)) + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 300)) for i in range(600)] + [(5, None), (None, 1), (700, 1), (7, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: (r["s"], r["o"]) for r in docs.select("doc_id", toxicity.score(F.col("text"), model).alias("s"), toxicity.offending(F.col("text"), model).alias("o")).collect()}
    assert got[400][0] > 0.5 and [o["number"] for o in got[400][1]] == [1] and got[400][1][0]["sentence"] == "you horrid pest"
    assert got[10][0] < 0.5 and got[10][1] == [] and got[900] == (0.0, []) and got[901] == (0.0, [])


def test_toxicity_odd_rows(spark):
    """Copies, disagreeing labels, null ids, a very long text and clashing columns; a table without rows."""
    calm, bad = "They are friendly here. Rain fell.", "You horrid pest."
    rows = [(i, calm if i % 2 else f"{calm} {bad}") for i in range(80)] + [(3, calm), (3, calm), (None, bad), (90, f"{calm} " * 20_000 + bad)]
    docs = spark.createDataFrame([(*r, 1, 1.0, "x") for r in rows], "doc_id long, text string, toxic int, score double, ends string")
    labels = spark.createDataFrame([(i, 1 - i % 2, "y") for i in range(80)] + [(2, 0, "y"), (4, 1, "y"), (90, 1, "y")], "doc_id long, toxic int, text string")
    model = toxicity.fit(docs, labels)
    got = docs.select("doc_id", toxicity.score(F.col("text"), model).alias("chance"), "score").collect()
    assert len(got) == len(rows) and all(0 <= r["chance"] <= 1 and r["score"] == 1.0 for r in got)
    by = {r["doc_id"]: r["chance"] for r in got}
    assert by[None] > 0.5 and by[2] > 0.5 and by[3] < 0.5 and by[90] >= by[None] * 0.5
    nothing = toxicity.fit(docs.limit(0), labels)
    assert docs.limit(0).select(toxicity.score(F.col("text"), nothing)).count() == 0 and toxicity.Model(*nothing).score(bad) == 0.0


def test_a_shift_keeps_the_order_and_moves_the_middle():
    totals = np.array([1e-9, 1e-3, 0.1, np.log(2), 3.0, 50.0])
    plain, moved = toxicity._shifted(totals, 0.0), toxicity._shifted(totals, 2.0)
    assert np.allclose(plain, -np.expm1(-totals)) and (np.diff(moved) > 0).all() and (moved > plain)[:-1].all()


def test_no_labels_no_scores(spark):
    docs = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert docs.select(toxicity.score(F.col("text"), model)).first()[0] == 0.0

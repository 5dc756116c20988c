import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyarrow import orc
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetspark.llm import chunks, token_files
from fleetspark.llm.common import new_path

PATH, END = public_tokenizers.path("word_bpe_49k.json"), 2
PARTS = ["a", "It", "'s", "'", " ", "  ", "\n", "\t", "é", "é", "́", "Σ", "ΑΣ", "1", "23", "<|endoftext|>", "<|startoftext|>", "<|end", "漢字", "\x85", "\xa0", " ", "!?", "İ", "ﬁ", "\U0001f600", "word"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def plain(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_words_as_the_library_encodes_texts(library, monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 20))) for _ in range(3000)]
    for slab, kept in ((1 << 20, 1 << 20), (7, 2000)):
        monkeypatch.setattr(chunks, "SLAB", slab)
        monkeypatch.setattr(chunks, "KEPT_BYTES", kept)
        fresh = token_files.WordIds(PATH, True)
        got = [ids for at in range(0, len(texts), 100) for ids in fresh.encode(texts[at : at + 100])]
        assert fresh.simple and [np.frombuffer(x, "<i4").tolist() for x in got] == [plain(library, t) for t in texts]
    assert [np.frombuffer(x, "<i4").tolist() for x in token_files.WordIds(PATH, False).encode(texts[:50])] == [plain(library, t) for t in texts[:50]]


def test_each_short_word_as_the_library_encodes_it(library):
    """All pairs of characters of ASCII and Latin-1, and some others, cut here or not."""
    some = [chr(c) for c in range(1, 260)] + ["Σ", "ʼ", "̈", "\u2028"]
    fresh, words = token_files.WordIds(PATH, True), [a + b for a in some for b in some if " " not in a + b]
    fresh.learn(set(words))
    assert all(fresh.words[w] == np.array(e.ids, "<i4").tobytes() for w, e in zip(words, library.encode_batch(words, add_special_tokens=False)))


def test_words_that_differ_by_case_and_marks_share_their_pieces(library):
    """Only words with characters beyond Latin-1 are kept whole; of others, in many guises, the pieces are."""
    rng = random.Random(2)
    words = ["Straße", "don't", "WE'LL", "they're", "i'M", "o'clock", "''s", "x'reve", "été", "end"]
    texts = [" ".join(rng.choice("(*-\"['") + w + rng.choice((".", ",", "!?", "'s", "'", ")\n", "\tÜ")) for w in rng.choices(words, k=40)) for _ in range(300)]
    fresh = token_files.WordIds(PATH, True)
    assert [np.frombuffer(x, "<i4").tolist() for x in fresh.encode(texts)] == [plain(library, t) for t in texts]
    assert not fresh.words and len(fresh.pieces) < 100
    mixed = [texts[0] + " Σ漢 " + texts[1], "a" + texts[2] + "\u0301", texts[3], "漢 x 字 Σb-Σc  \u0301 y", " \u0301", "“It’s <b>”", "x漢"]
    assert [np.frombuffer(x, "<i4").tolist() for x in fresh.encode(mixed)] == [plain(library, t) for t in mixed]
    assert {"Σ漢", "字", "Σb-Σc", "“It’s", "<b>”", "x漢"} < set(fresh.words) and not any(w.isascii() for w in fresh.words)


ROWS = [
    (5, None, 1, "x"), (3, "", 2, "x"), (9, "Hello  World", 3, "y"), (9, "another text of id 9", 4, "y"), (9, "another text of id 9", 4, "y"),
    (None, "no id", 5, "z"), (1, "<|endoftext|> inside", 6, None), (2, "long words " * 40000, 7, None), (4, "x" * 5000, 8, None),
]


def test_a_table_and_its_copies(spark, library):
    docs = spark.createDataFrame(ROWS, "doc_id int, text string, part int, ids string")
    path = new_path(spark, "t-token-files")
    token_files.write_tokens(docs, path, PATH, END, partitions=3)
    got = sorted(token_files.read_tokens(spark, path).withColumn("crc", token_files.ids_crc32(F.col("ids"))).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 5, 9, 9, 9]
    at = 0
    for r in got:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"])) and r["crc"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    want = sorted((str(i), plain(library, t) + [END]) for i, t, *_ in ROWS)
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == want
    again = new_path(spark, "t-token-files")
    token_files.write_tokens(docs.orderBy(F.rand()), again, PATH, END, partitions=3)
    assert sorted(token_files.read_tokens(spark, again).drop("ids").collect(), key=str) == sorted(token_files.read_tokens(spark, path).drop("ids").collect(), key=str)


def test_an_empty_table(spark):
    path = new_path(spark, "t-token-files")
    token_files.write_tokens(spark.createDataFrame([], "doc_id long, text string"), path, PATH, END)
    assert token_files.read_tokens(spark, path).count() == 0 and token_files.read_span(spark, path, 0, 9).count() == 0


def scanned(df):
    """Rows that the file scan gave, before the filter above it."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().get("numOutputRows").get().value()


def test_metadata_leaves_rows_out(spark):
    docs = spark.range(20000).select((F.col("id") * 2).alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text"))
    path = new_path(spark, "t-token-files")
    token_files.write_tokens(docs, path, PATH, END, partitions=4)
    ids = spark.read.orc(f"{path}/ids")
    assert scanned(ids) == 20000
    assert scanned(ids.where(F.col("doc_id").isin(7000))) <= token_files.GROUP_ROWS
    assert sum(scanned(ids.where(F.col("doc_id").isin(i))) == 0 for i in range(7001, 7201, 2)) > 90  # within the minima and maxima of a group: Bloom filters
    assert [r["doc_id"] for r in token_files.read_documents(spark, path, [7000, 7001, 39998]).orderBy("doc_id").collect()] == [7000, 39998]
    file = orc.ORCFile(ids.inputFiles()[0].removeprefix("file:"))
    assert (file.compression, file.row_index_stride) == ("ZSTD", token_files.GROUP_ROWS)
    whole = [i for r in token_files.read_tokens(spark, path).orderBy("start").collect() for i in r["ids"]]
    for start, stop in ((0, 5), (1003, 1003), (1003, 1004), (25000, 75000), (len(whole) - 3, len(whole) + 9), (len(whole), len(whole) + 1)):
        rows = token_files.read_span(spark, path, start, stop).orderBy("start").collect()
        assert [i for r in rows for i in r["ids"]] == whole[start:stop] and all(r["ids"] for r in rows)


def test_stripes_are_read_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(token_files, "STRIPE_BYTES", 64 << 10)
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.sha2(F.concat(F.col("id"), F.lit(k)), 256) for k in range(4)]).alias("text"))
    path = new_path(spark, "t-token-files")
    token_files.write_tokens(docs, path, PATH, END, partitions=1)
    (file,) = spark.read.orc(f"{path}/ids").inputFiles()
    assert orc.ORCFile(file.removeprefix("file:")).nstripes > 3
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        rows = token_files.read_tokens(spark, path)
        tasks = rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
        assert len(tasks) > 3 and sum(r["n"] for r in tasks) == 6000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)

import collections

import public_tokenizers
import tiktoken

import corpus_pipeline
from fleetspark.llm import bpe, language_id
from fleetspark.llm.common import stored
from tests.llm import brute
from tests.llm.test_mixing import targets


def test_stages_as_plain_versions_do(spark, sf_dir):
    """Each stage on what the one before it kept, row by row."""
    docs = corpus_pipeline.documents(spark, sf_dir)
    columns, found, inputs = docs.columns, {}, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs.collect()
        docs = stored(stage(spark, docs, sf_dir), name)
        found[name] = docs.collect()
        assert name == "byte_bpe" or docs.columns == columns
    ids = {name: sorted(r["doc_id"] for r in rows) for name, rows in found.items()}

    first = spark.createDataFrame(inputs["language_id"])
    judge = language_id.Identifier(language_id.fit(first.where(~language_id.held_out())))
    assert ids["language_id"] == sorted(r["doc_id"] for r in inputs["language_id"] if not judge(r["text"])[2]) and len(ids["language_id"]) >= 195

    last = {r["text"] or "": max(x["doc_id"] for x in inputs["exact_dedup"] if x["text"] == r["text"]) for r in inputs["exact_dedup"]}
    assert ids["exact_dedup"] == sorted(last.values())

    groups = brute.alike([(r["doc_id"], r["text"]) for r in inputs["ngram_join"]], 5, 80)
    assert ids["ngram_join"] == sorted(i for i, (_, least) in groups.items() if i == least) and len(ids["ngram_join"]) < len(ids["exact_dedup"])

    by_id, sizes, taken, times = {r["doc_id"]: r for r in inputs["mixing"]}, collections.Counter(), collections.Counter(), collections.Counter()
    for r in inputs["mixing"]:
        sizes[r["source"]] += len(r["text"].encode().split())
    for r in found["mixing"]:
        whole = by_id[r["doc_id"]]
        assert r["text"] == whole["text"] or whole["text"].encode().split()[: len(r["text"].split(" "))] == r["text"].encode().split(b" ")
        assert r["n_chars"] == len(r["text"]) and r["lang"] == whole["lang"]
        taken[r["source"]] += len(r["text"].encode().split())
        times[r["doc_id"]] += 1
    want = targets(dict(sizes))
    assert max(times.values()) <= 2 and all(abs(taken[s] - want[s]) <= 1 for s in sizes)

    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    texts = collections.Counter((r["doc_id"], tuple(reference.encode_ordinary(r["text"]))) for r in inputs["byte_bpe"])
    assert collections.Counter((r["doc_id"], tuple(r["ids"])) for r in found["byte_bpe"]) == texts
    assert all(len(r["ids"]) == r["n_tokens"] for r in found["byte_bpe"])


def test_the_mix_lies_in_shards(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "SHARD_BLOCKS", 1)
    docs = corpus_pipeline.documents(spark, sf_dir)
    rows = corpus_pipeline.mix_sources(spark, docs, sf_dir).collect()
    again = corpus_pipeline.mix_sources(spark, docs.repartition(5), sf_dir).collect()
    assert collections.Counter(rows) == collections.Counter(again)
    assert [r["doc_id"] for r in rows] != sorted(r["doc_id"] for r in rows)


def test_odd_documents_pass_through(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, "the cat sat on the mat", "en", None, 1), (2, None, None, None, None), (3, "", "en", "s", 0), (4, "der hund und die katze", "de", "s", 1), (4, "der hund und die katze", "de", "s", 1)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    assert {r["doc_id"] for r in docs.collect()} <= {None, 4}
    empty = spark.createDataFrame([], schema)
    for name, stage in corpus_pipeline.STAGES:
        empty = stored(stage(spark, empty, sf_dir), name)
    assert empty.count() == 0

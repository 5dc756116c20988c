"""The registered queries of the corpus operators, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm import alignment, bpe, exact_dedup, fingerprints, language_id, mixing, ngram_join, suffix_array, suffix_trees, token_files, toxicity, warc, whitening
from fleetspark.llm.common import documents, new_path, short_batches

#: The vocabulary that op7 encodes with; its place is a parameter of the operator.
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The tokenizer of op12's files, and the id behind each document.
FILE_TOKENIZER, END_ID = "word_bpe_49k.json", 2
#: The two tokenizers that op13 aligns.
TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.label(documents(spark, sf_dir))
    return found.select("doc_id", "__li.held_out", "__li.lang_pred", "__li.score", "__li.rejected")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edits(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    scored = docs.select("doc_id", toxicity.held_out().alias("held_out"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_by_document(mixing.mix(documents(spark, sf_dir)))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    archives = warc.write_archives(warc.with_revisits(pages), new_path(spark, "warc"))
    records = warc.read_archives(archives, with_payload=False)
    return records.select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


OP5_SQL = """
SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
       CASE WHEN r THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN r THEN first END AS refers_to
FROM (SELECT *, strlen(coalesce(html, '')) >= 100 AND page_id <> first AS r
      FROM (SELECT *, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages))
"""


def op6_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_trees.without_repeats(documents(spark, sf_dir)).drop("kept_text")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    short_batches(spark)
    found = bpe.digests(F.col("text"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return documents(spark, sf_dir).select("doc_id", found.alias("d")).select("doc_id", "d.*")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.without_repeats(documents(spark, sf_dir)).drop("kept")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.alike(documents(spark, sf_dir), n=3, percent=90)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = whitening.whiten(vectors, whitening.fit(vectors))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "token-files")
    token_files.write_tokens(documents(spark, sf_dir), path, public_tokenizers.path(FILE_TOKENIZER), END_ID)
    return token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", token_files.ids_crc32(F.col("ids")).alias("ids_crc32"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    aligned = alignment.align(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER_A), public_tokenizers.path(TOKENIZER_B))
    return alignment.with_counts(aligned, alignment.pair_counts(aligned))


OP8_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_fingerprints": op2_fingerprints,
        "op3_toxicity": op3_toxicity,
        "op4_mixing": op4_mixing,
        "op5_warc": op5_warc,
        "op6_suffix_trees": op6_suffix_trees,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_suffix_array": op9_suffix_array,
        "op10_ngram_join": op10_ngram_join,
        "op11_whitening": op11_whitening,
        "op12_token_files": op12_token_files,
        "op13_alignment": op13_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_warc": OP5_SQL, "op8_exact_dedup": OP8_SQL}

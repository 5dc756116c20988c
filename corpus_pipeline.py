"""From raw documents to token ids: five stages, each a Parquet table that the next one reads.

Rejected languages go; of exact copies the largest id stays; of near copies (five-word shingles, similarity of 0.8 or more)
the smallest id stays; sources are mixed to their target weights; what is taken is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm import bpe, exact_dedup, language_id, mixing, ngram_join
from fleetspark.llm.common import WORD, documents, short_batches, stored, whole

#: No SQL has language models, permutations or merges in it; tests hold the stages against brute force.
ORACLE_SQL = None
#: Blocks of a shard of the mix.
SHARD_BLOCKS = 512
#: Bytes of chunks that a worker keeps in the last stage, less than where it runs alone: a worker serves all stages.
CHUNK_BYTES = 40 << 20


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; null and empty texts, those without letters, or as near to two languages, go. Rows are on their own."""
    return language_id.label(docs).where(~F.col("__li.rejected")).select(docs.columns)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null is empty) the row with the largest id; a null id is less than any, and of rows alike in both one stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id; rows without words have none, and rows with a null id stay."""
    return ngram_join.drop_near_duplicates(docs, n=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time a document is taken; where a source's target ends inside a document, its words up to there.

    The tree decides where: a row lies in the shard that drew its first block, in the shard's own order. Texts are distinct
    by now, so their hash names a row even where an id is null; a null text has no words and isn't taken, and rows that repeat a
    text would be joined with what either takes.
    """
    named = docs.withColumn("__mx_name", F.sha2(whole(), 256))
    pieces = mixing.mix(named, id_col="__mx_name", shard_blocks=SHARD_BLOCKS).where("shard IS NOT NULL")
    firsts = [F.min_by(c, "block").alias(f"__mx_{c}") for c in ("shard", "order_key")]
    taken = pieces.groupBy(F.col("doc_id").alias("__mx_name"), "epoch", F.col("size").alias("__mx_size")).agg(F.sum("words").alias("__mx_words"), *firsts)
    words = F.slice(F.regexp_extract_all(whole(), F.lit(WORD), F.lit(0)), F.lit(1), F.col("__mx_words").cast("int"))
    text = F.when(F.col("__mx_words") == F.col("__mx_size"), F.col("text")).otherwise(F.array_join(words, " "))
    mixed = named.join(stored(taken, "mx-taken"), "__mx_name").withColumn("text", text).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return mixed.repartition("__mx_shard").sortWithinPartitions("__mx_shard", "__mx_order_key").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, ids, n_tokens, ids_sha256, decoded_sha256`` of each row; a null text has no ids, and repeated rows stay."""
    import public_tokenizers

    short_batches(spark)
    encoded = bpe.encoded(F.col("text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, CHUNK_BYTES)
    return docs.select("doc_id", "source", encoded.alias("e")).select("doc_id", "source", "e.*")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact),
    ("ngram_join", drop_near),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Exact dedup by progressive refinement, in DataFrame functions only.

Rows are grouped by the length of their text, then by a hash of its first characters, and only rows still in a group
are hashed in full. What is shuffled is a few numbers a row, never a text.

Defined cases: a null text is empty; a null id loses to any other; an empty table gives an empty result. Rows that
repeat both id and text are one document: ``exact_groups`` gives each the same decision, ``drop_exact_duplicates``
leaves one of them. Input columns may have any name not starting with ``__xd``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import BROADCAST_BYTES, ROW_BYTES, broadcast_if_small, stored, whole

PREFIX_CHARS = 256
LENGTH, PREFIX, FULL = "__xd_length", "__xd_prefix", "__xd_full"


def _groups(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int, broadcast_bytes: int) -> DataFrame:
    """Groups of two rows or more: length, prefix hash, full hash, id that stays, rows, rows that have that id."""
    text = whole(text_col)
    keyed = docs.select(
        F.col(id_col).alias("__xd_id"),
        text.alias("__xd_text"),
        F.octet_length(text).alias(LENGTH),
        F.xxhash64(F.substring(text, 1, prefix_chars)).alias(PREFIX),
    )
    narrow = stored(keyed.groupBy(LENGTH, PREFIX).agg(F.count("*").alias("__xd_n")), "xd-lengths")
    lengths = narrow.groupBy(LENGTH).agg(F.sum("__xd_n").alias("__xd_same")).where("__xd_same > 1").select(LENGTH)
    survivors = stored(narrow.where("__xd_n > 1").join(lengths, LENGTH, "left_semi").select(LENGTH, PREFIX), "xd-prefixes")
    small = survivors.count() * ROW_BYTES <= broadcast_bytes
    full = F.sha2(F.col("__xd_text"), 256).alias(FULL)
    if small:  # the hash is computed behind the join, for survivors alone
        left = keyed.join(F.broadcast(survivors), [LENGTH, PREFIX], "left_semi").select("__xd_id", LENGTH, PREFIX, full)
    else:  # hashing is cheaper than moving texts to the join
        left = keyed.select("__xd_id", LENGTH, PREFIX, full).join(survivors, [LENGTH, PREFIX], "left_semi")
    by_id = left.groupBy(LENGTH, PREFIX, FULL, "__xd_id").agg(F.count("*").alias("__xd_rows"))
    return (
        by_id.groupBy(LENGTH, PREFIX, FULL)
        .agg(
            F.max("__xd_id").alias("__xd_keep"),
            F.sum("__xd_rows").alias("__xd_size"),
            F.coalesce(F.max_by("__xd_rows", "__xd_id"), F.max("__xd_rows")).alias("__xd_top"),
        )
        .where("__xd_size > 1")
    )


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The rows of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``; the largest id of equal texts stays.

    Selecting few columns of the result keeps texts out of every shuffle. If the groups are many, the last join
    shuffles ids and hashes, and adaptive execution splits the partition of a hot group.
    """
    text = whole(text_col)
    groups = broadcast_if_small(stored(_groups(docs, id_col, text_col, prefix_chars, broadcast_bytes), "xd-groups"), 3 * ROW_BYTES, broadcast_bytes)
    rows = docs.drop("keep_id", "group_size", "kept", "text_sha256").withColumns(
        {LENGTH: F.octet_length(text), PREFIX: F.xxhash64(F.substring(text, 1, prefix_chars)), FULL: F.sha2(text, 256)}
    )
    return (
        rows.join(groups, [LENGTH, PREFIX, FULL], "left")
        .withColumns(
            {
                "keep_id": F.when(F.col("__xd_size").isNull(), F.col(id_col)).otherwise(F.col("__xd_keep")),
                "group_size": F.coalesce("__xd_size", F.lit(1)).cast("long"),
                "kept": F.col("__xd_size").isNull() | F.col(id_col).eqNullSafe(F.col("__xd_keep")),
                "text_sha256": F.col(FULL),
            }
        )
        .drop(LENGTH, PREFIX, FULL, "__xd_keep", "__xd_size")
        .withColumnRenamed("__xd_top", "__xd_ties")
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without the rows whose text another row with a larger id has; its columns are those of ``docs``."""
    groups = exact_groups(docs.withColumns({f"__xd_in_{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)}), id_col, text_col, **settings)
    kept = groups.where("kept").select(*[F.col(f"__xd_in_{i}").alias(c) for i, c in enumerate(docs.columns)], F.col("text_sha256").alias("__xd_sha"), "__xd_ties")
    tied = F.coalesce(F.col("__xd_ties"), F.lit(1)) > 1
    once = kept.where(~tied).unionByName(kept.where(tied).dropDuplicates(["__xd_sha"]))
    return once.drop("__xd_sha", "__xd_ties")

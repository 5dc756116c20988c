"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree, in DataFrame functions only.

1. Targets: sources by code point (null last) weigh ``weights`` in turn and share ``share`` of all words; a target
   stops at ``epochs`` times its source's size and the excess goes to the others by weight.
2. Quotas: a source's documents, permuted by a hash, form a stream that is run through up to ``epochs`` times. The mix
   takes the first ``target`` words of it, cut into blocks of ``block_words``; the last block may be shorter.
3. Tree: the output shards are halved again and again; at each node the left half draws its share of every source's
   remaining block quota from the multivariate hypergeometric distribution, so each shard ends up with the counts that
   a global shuffle of all blocks would give it, and quotas are met exactly.
4. Each shard takes the next unused blocks of each source, and ``write_shards`` orders them locally by a hash.

Everything random is a hash of seed and position, so reruns agree. A row is placed by the hash of its id and size in
one of many buckets, whose sizes are summed first: no source, however hot, passes through one task.

Defined cases: a null text has size 0; a document of size 0 is taken 0 times; a null source is a source of its own;
repeated rows are placed one by one; null ids are placed like others. An empty table gives an empty result. Internal
columns start with ``__mx``; no other name clashes.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.llm.common import ROW_BYTES, WORD, broadcast_if_small, stored, whole

WEIGHTS, SHARE, EPOCHS = (5, 2, 1), 1.5, 2
BLOCK_WORDS, SHARD_BLOCKS, BUCKET_ROWS, RUN_BUCKETS = 4096, 2048, 4096, 1024
#: Nodes of the tree from which on they are dealt out.
SPREAD_NODES = 64


def sizes_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Id, source and size in words of each document."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.regexp_count(whole(text_col), F.lit(WORD)).cast("long").alias("size"),
    )


def source_targets(sizes: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Per source: ``source, __mx_source (its place), source_size, target``.

    Filling by weight up to a cap has a closed form: with sources sorted by cap over weight, the common level is the
    largest of (total - caps before) / (weights from here), and a target is min(cap, weight * level). The windows see
    one row a source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("__mx_source") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(epochs))
    by_ratio = Window.orderBy(F.col("__mx_cap") / F.col("__mx_weight"), "__mx_source")
    before, after, every = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    level = (F.col("__mx_total") - F.coalesce(F.sum("__mx_cap").over(before), F.lit(0.0))) / F.sum("__mx_weight").over(after)
    return (
        by_source.withColumn("__mx_source", place)
        .withColumns({"__mx_weight": turn, "__mx_cap": cap, "__mx_total": F.sum("source_size").over(every) * F.lit(share)})
        .withColumn("__mx_level", level)
        .withColumn("target", F.least("__mx_cap", F.col("__mx_weight") * F.max("__mx_level").over(every)))
        .select("source", "__mx_source", "source_size", "target")
    )


#: The draw of one node, as SQL text: one parse instead of thousands of calls into the JVM. In it, s is the state of the
#: left half (population and draws still open, counts taken), m the blocks of the source at hand.
#: - drawn: how many of s.draws from s.population are marked, by inverting the hypergeometric distribution within ten
#:   deviations of its mean; log_p is ln of C(m, x) C(population - m, draws - x) up to a constant.
#: - _let(a, v -> b) is b with v computed once, since nothing is shared between lambdas otherwise.


def _let(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _log_factorial(k: str) -> str:
    """ln k! by Stirling's series at k + 4."""
    series = "(x - 0.5D) * ln(x) - x + 0.9189385332046727D + 1 / (12 * x) - 1 / (360 * x * x * x) - ln((x - 1) * (x - 2) * (x - 3))"
    return _let(f"double({k}) + 4", "x", series)


def _drawn(u: str) -> str:
    mean = "double(s.draws) * m / s.population"
    spread = "10 + 10 * sqrt(greatest(0D, mean * (1 - double(m) / s.population) * (s.population - s.draws) / greatest(1D, s.population - 1D)))"
    low = "greatest(0L, s.draws - (s.population - m), bigint(floor(mean - spread)))"
    high = "least(m, s.draws, bigint(ceil(mean + spread)))"
    log_p = f"-({_log_factorial('k')} + {_log_factorial('m - k')} + {_log_factorial('s.draws - k')} + {_log_factorial('s.population - m - s.draws + k')})"
    total = "aggregate(p, 0D, (t, x) -> t + x)"
    below = "aggregate(p, struct(0D AS t, 0L AS n), (a, x) -> struct(a.t + x AS t, a.n + if(a.t + x < goal, 1L, 0L) AS n), a -> a.n)"
    counted = _let(f"transform(logs, x -> exp(x - top))", "p", _let(f"{u} * {total}", "goal", below))
    at_mean = "element_at(logs, int(greatest(low, least(high, bigint(floor(mean)))) - low + 1))"
    sampled = f"least(high, low + {_let(f'transform(sequence(low, high), k -> {log_p})', 'logs', _let(at_mean, 'top', counted))})"
    sampled = _let(mean, "mean", _let(spread, "spread", _let(low, "low", _let(high, "high", sampled))))
    return f"CASE WHEN s.draws <= 0 OR m <= 0 THEN 0L WHEN s.draws >= s.population THEN m ELSE {sampled} END"


def split_quotas(quotas: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``__mx_source, shard, offset, blocks``: how many blocks of each source a shard gets and where they start.

    ``quotas`` has ``__mx_source, quota``, one row a source. The tree has one row a node with arrays over sources: blocks, and
    where they start in each source's stream. Each level is a narrow map; a level of more than ``SPREAD_NODES`` nodes is dealt out first.
    """
    nodes = quotas.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__mx_source", "quota"))), lambda x: x["quota"]).alias("q"),
        F.sum("quota").alias("all"),
    ).selectExpr("0L AS lo", f"{shards}L AS hi", "q", "transform(q, x -> 0L) AS o", "`all`").where("`all` IS NOT NULL")
    u = f"pmod(xxhash64({seed}, lo, hi, size(s.taken)), {1 << 53}L) / {float(1 << 53)!r}D"
    begin = "struct(aggregate(q, 0L, (t, x) -> t + x) AS population, n AS draws, cast(array() AS array<bigint>) AS taken)"
    step = _let(_drawn(u), "x", "struct(s.population - m AS population, s.draws - x AS draws, concat(s.taken, array(x)) AS taken)")
    for level in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        if 1 << level in (SPREAD_NODES, SPREAD_NODES**2):
            nodes = nodes.repartition(1 << level, "lo")
        # a node of shards [lo, hi) has the blocks from lo * all div shards on; mid halves it
        halved = nodes.selectExpr("*", "(lo + hi) div 2 AS mid").selectExpr("*", f"mid * `all` div {shards} - lo * `all` div {shards} AS n")
        halved = halved.selectExpr("*", f"if(hi - lo > 1, aggregate(q, {begin}, (s, m) -> {step}, s -> s.taken), NULL) AS taken")
        nodes = halved.selectExpr(
            """explode(if(taken IS NULL, array(struct(lo, hi, q, o)), array(
                struct(lo, mid AS hi, taken AS q, o),
                struct(mid AS lo, hi, zip_with(q, taken, (a, b) -> a - b) AS q, zip_with(o, taken, (a, b) -> a + b) AS o)))) AS c""",
            "`all`",
        ).selectExpr("c.*", "`all`")
    return nodes.selectExpr("lo AS shard", "posexplode(arrays_zip(q, o)) AS (__mx_source, c)").selectExpr("__mx_source", "shard", "c.o AS offset", "c.q AS blocks")


def _sums_before(cells: DataFrame) -> DataFrame:
    """``__mx_source, __mx_bucket, __mx_base``: the words in a source's buckets before each, by sums over runs of buckets first."""
    runs = cells.withColumn("__mx_run", F.expr(f"__mx_bucket div {RUN_BUCKETS}"))
    whole_runs = runs.groupBy("__mx_source", "__mx_run").agg(F.sum("__mx_words").alias("__mx_all"))
    so_far = Window.partitionBy("__mx_source").orderBy("__mx_run").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("__mx_source", "__mx_run").orderBy("__mx_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = whole_runs.select("__mx_source", "__mx_run", F.coalesce(F.sum("__mx_all").over(so_far), F.lit(0)).alias("__mx_before"))
    base = F.col("__mx_before") + F.coalesce(F.sum("__mx_words").over(inside), F.lit(0))
    return runs.join(before, ["__mx_source", "__mx_run"]).select("__mx_source", "__mx_bucket", base.alias("__mx_base"))


def mix(
    docs: DataFrame,
    share: float = SHARE,
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: int = 0,
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    bucket_rows: int = BUCKET_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Pieces of documents in the mix, and one row with null ``shard`` for a document the mix doesn't take.

    ``doc_id, source, size, source_size, target, row_key (struct), shard, block, epoch, from_word, words, order_key``:
    shard ``shard`` holds ``words`` words of the document from word ``from_word`` on, placed by ``order_key``.
    """
    sizes = stored(sizes_of(docs, id_col, text_col, source_col), "mx-sizes")
    targets = stored(source_targets(sizes, share, weights, epochs), "mx-targets")
    quota = F.ceil(F.round("target") / block_words).cast("long")
    facts = targets.agg(F.sum(quota).alias("blocks")).first()
    shards = max(1, math.ceil((facts["blocks"] or 0) / shard_blocks))
    buckets = max(1, math.ceil(sizes.count() / bucket_rows))

    shares = split_quotas(targets.select("__mx_source", quota.alias("quota")), shards, seed)
    owners = shares.where("blocks > 0").select("__mx_source", "shard", F.explode(F.sequence("offset", F.col("offset") + F.col("blocks") - 1)).alias("block"))

    known = broadcast_if_small(targets, F.lit(ROW_BYTES) + F.coalesce(F.octet_length("source"), F.lit(0)))
    placed = (
        sizes.alias("d").join(known.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
        .select("d.doc_id", "d.source", "d.size", "t.__mx_source", "t.source_size", "t.target")
        .withColumn("__mx_hash", F.xxhash64(F.lit(seed), "doc_id", "size", "source"))
        .withColumn("__mx_bucket", F.pmod("__mx_hash", F.lit(buckets)))
    )
    cells = placed.groupBy("__mx_source", "__mx_bucket").agg(F.sum("size").alias("__mx_words"))
    inside = Window.partitionBy("__mx_source", "__mx_bucket").orderBy("__mx_hash", "doc_id", "size")
    lined = placed.withColumns(
        {
            "__mx_row": F.row_number().over(inside),
            "__mx_at": F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        }
    ).join(_sums_before(cells), ["__mx_source", "__mx_bucket"])

    goal = F.round("target").cast("long")
    copies = lined.withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(epochs)])))
    copies = copies.withColumn("__mx_from", F.col("__mx_base") + F.col("__mx_at") + F.col("epoch") * F.col("source_size"))
    copies = copies.withColumn("__mx_to", F.least(F.col("__mx_from") + F.col("size"), goal))
    taken = F.col("__mx_to") > F.col("__mx_from")
    first, last = (F.call_function("div", x, F.lit(block_words).cast("long")) for x in (F.col("__mx_from"), F.col("__mx_to") - 1))
    pieces = copies.where(taken | (F.col("epoch") == 0)).withColumn("block", F.explode_outer(F.when(taken, F.sequence(first, last))))
    start = F.greatest("__mx_from", F.col("block") * block_words)
    end = F.least("__mx_to", (F.col("block") + 1) * block_words)
    return pieces.join(owners, ["__mx_source", "block"], "left").select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.struct("__mx_source", "__mx_bucket", "__mx_row").alias("row_key"),
        "shard",
        "block",
        F.when(F.col("block").isNotNull(), F.col("epoch")).alias("epoch"),
        F.when(F.col("block").isNotNull(), start - F.col("__mx_from")).alias("from_word"),
        F.when(F.col("block").isNotNull(), end - start).otherwise(0).alias("words"),
        F.xxhash64(F.lit(seed), "shard", "__mx_source", "block", "__mx_hash").alias("order_key"),
    )


def taken_by_document(pieces: DataFrame) -> DataFrame:
    """Per document: ``doc_id, source, size, source_size, target, taken``."""
    return pieces.groupBy("doc_id", "source", "size", "source_size", "target", "row_key").agg(F.sum("words").alias("taken")).drop("row_key")


def shard_texts(docs: DataFrame, pieces: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts of the pieces: ``shard, order_key, doc_id, text`` (words joined by one space). Ids are to be unique."""
    words = F.regexp_extract_all(whole(text_col), F.lit(WORD), F.lit(0))
    texts = docs.select(F.col(id_col).alias("__mx_id"), words.alias("__mx_list"))
    got = pieces.where("shard is not null").join(texts, F.col("doc_id") == F.col("__mx_id"))
    piece = F.slice("__mx_list", (F.col("from_word") + 1).cast("int"), F.col("words").cast("int"))
    return got.select("shard", "order_key", "doc_id", F.array_join(piece, " ").alias("text"))


def write_shards(docs: DataFrame, pieces: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write each shard's pieces in their shuffled order, partitioned by shard."""
    shard_texts(docs, pieces, id_col, text_col).repartition("shard").sortWithinPartitions("shard", "order_key").write.partitionBy("shard").parquet(path)

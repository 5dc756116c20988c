"""Near-duplicate agents: instructions whose sets of words are alike, as clusters, with their likeness to the cluster's first.

Words become sparse vectors (HashingTF), MinHashLSH gives each distinct set of words ``BANDS * ROWS`` minima, and sets that agree in all
minima of a band meet in a bucket. A bucket is a star: every set is held against the bucket's first one, by the words themselves; only
sets that aren't like the first meet the bucket's others. So a large group of copies of one template costs as many comparisons as it has
members, and no link between sets of a bucket is lost. Two sets of Jaccard similarity J never meet with a chance of (1 - J^ROWS)^BANDS,
which is 0.00003 at 0.8. Equal sets are one row from the start.

Texts are long and minima are not, so no table of all words is stored or shuffled. Each agent leaves its minima, the size of its set and a bitmap
of its words' hashes; these give the pairs and an upper bound of their likeness, and only of pairs whose bound is high enough are the words read
again. TF-IDF reads the words of agents in clusters; each is counted together with its cluster's first inside its row.
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, MinHashLSH
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.functions import expressions as x
from fleetspark.sources.scratch import folder

WORD = r"[\p{L}\p{N}]+"
BANDS, ROWS, FEATURES = 20, 4, 1 << 18
#: Bits of the bitmap of a set's words, in longs of 64.
BITS = 2048
#: A side joined by broadcast has at most so many bytes, as its rows are counted.
BROADCAST_BYTES = 32 << 20
_MINIMA = "agent_id long, name binary, n int, bits array<long>, hashes array<struct<type:tinyint,size:int,indices:array<int>,values:array<double>>>"


def _stored(df: DataFrame, name: str, schema: str | None = None) -> DataFrame:
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def words(text: str | Column) -> Column:
    """The words of a text in lower case; null has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(x.c(text), F.lit(""))), F.lit(WORD), F.lit(0))


def terms(text: str | Column) -> Column:
    """The distinct words of a text, in order."""
    return F.sort_array(F.array_distinct(words(text)))


def likeness(a: str | Column, b: str | Column) -> Column:
    """Jaccard similarity of two columns of distinct words."""
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of the nodes of ``a, b`` pairs: the smallest node that can be reached.

    In each round a node takes the smallest label around it and then that label's own label, so chains halve; rounds are stored.
    """
    both = _stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = _stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("least"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("before"), F.least("label", "least").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        done = _stored(lower.join(jump, "label", "left").select("node", "before", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        labels = done.select("node", "label")
        if done.where("before <> label").isEmpty():
            return labels.select("node", F.col("label").alias("component"))


def _once(column: Column) -> Column:
    """A value that is computed once a row, however often later expressions read it: a generator, so that these are not merged with it."""
    return F.explode(F.array(column))


def _small(df: DataFrame, size: Column | int) -> DataFrame:
    """A stored table, marked for broadcast if its rows of ``size`` bytes sum up to ``BROADCAST_BYTES`` at most; else its join shuffles."""
    held = df.agg(F.sum((size if isinstance(size, Column) else F.lit(size)).cast("long"))).first()[0]
    return F.broadcast(df) if (held or 0) <= BROADCAST_BYTES else df


def _of(told: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``told`` whose ``agent_id`` is among stored, distinct ones; texts stay where they are read while the ids are few."""
    return told.join(_small(ids, 16), "agent_id")


def minima(told: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Of each agent with words (``agent_id, text``) what pairs are found by: a name and the size of its set of words, a bitmap and the minima."""
    sets = told.select("agent_id", _once(terms("text")).alias("terms")).where(F.size("terms") > 0)
    spread = F.transform("terms", lambda t: F.pmod(F.xxhash64(t), F.lit(BITS)).cast("int"))
    sets = sets.select("agent_id", "terms", _once(spread).alias("places"))
    bits = F.expr(f"transform(sequence(0, {BITS // 64 - 1}), i -> aggregate(filter(places, p -> p div 64 = i), 0L, (held, p) -> held | shiftleft(1L, p % 64)))")
    name = F.unhex(F.sha2(F.concat_ws(" ", "terms"), 256))
    named = sets.select("agent_id", "terms", name.alias("name"), F.size("terms").alias("n"), bits.alias("bits"))
    hashed = HashingTF(inputCol="terms", outputCol="features", binary=True, numFeatures=FEATURES).transform(named)
    model = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=bands * rows, seed=7).fit(hashed)
    return _stored(model.transform(hashed).select("agent_id", "name", "n", "bits", "hashes"), "minima", _MINIMA)


def _pairs(rows: DataFrame, least: float) -> DataFrame:
    """Distinct ``a, b`` of ``a, b, a_n, b_n`` rows whose sizes alone don't make them too unlike."""
    return rows.where((F.col("a_n") >= least * F.col("b_n") - 1e-6) & (F.col("b_n") >= least * F.col("a_n") - 1e-6)).select("a", "b").distinct()


def links(told: DataFrame, sets: DataFrame, least: float = 0.8, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``a, b`` of sets (``set_id, n, bits, hashes``, as ``minima`` has them) that are alike by their agents' words, as many as join all sets that a bucket joins."""
    band = F.expr(f"transform(sequence(0, {bands - 1}), i -> xxhash64(i, transform(slice(hashes, i * {rows} + 1, {rows}), h -> h.values[0])))")
    keys = sets.select("set_id", "n", F.explode(band).alias("bucket"))
    first = F.min(F.struct("set_id", "n"))
    heads = keys.groupBy("bucket").agg(first.alias("head"), F.count("*").alias("k")).where("k > 1").select("bucket", F.col("head.set_id").alias("head"), F.col("head.n").alias("head_n"))
    buckets = _stored(keys.join(heads, "bucket").where("set_id <> head"), "buckets")

    def alike(pairs: DataFrame) -> DataFrame:
        """A set has at least one word that the other lacks for each bit that the other lacks, which bounds what both share."""
        a, b = (sets.select(F.col("set_id").alias(k), F.col("n").alias(f"{k}_n"), F.col("bits").alias(f"{k}_bits")) for k in ("a", "b"))
        lacking = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda s, v: s + v)
        most = F.least(F.col("a_n") - lacking("a_bits", "b_bits"), F.col("b_n") - lacking("b_bits", "a_bits"))
        near = _stored(pairs.join(a, "a").join(b, "b").where(most >= least / (1 + least) * (F.col("a_n") + F.col("b_n")) - 1e-6).select("a", "b"), "near")
        ids = _stored(near.select(F.col("a").alias("agent_id")).unionByName(near.select(F.col("b").alias("agent_id"))).distinct(), "ids")
        said = _of(told, ids).select("agent_id", F.concat_ws(" ", terms("text")).alias("said"))  # words hold no space; one text is a fraction of its list
        both = near.join(said.select(F.col("agent_id").alias("a"), F.col("said").alias("a_said")), "a").join(said.select(F.col("agent_id").alias("b"), F.col("said").alias("b_said")), "b")
        return both.where(likeness(F.split("a_said", " "), F.split("b_said", " ")) >= least).select("a", "b")

    stars = _stored(alike(_pairs(buckets.select(F.col("head").alias("a"), F.col("set_id").alias("b"), F.col("head_n").alias("a_n"), F.col("n").alias("b_n")), least)), "stars")
    apart = buckets.join(stars.select(F.col("a").alias("head"), F.col("b").alias("set_id")), ["head", "set_id"], "left_anti")
    others = buckets.select("bucket", F.col("set_id").alias("other"), F.col("n").alias("other_n"))
    met = apart.join(others, "bucket").where("set_id <> other").select(F.least("set_id", "other").alias("a"), F.greatest("set_id", "other").alias("b"), F.col("n").alias("a_n"), F.col("other_n").alias("b_n"))
    return stars.unionByName(alike(_pairs(met, least)))


def near_duplicates(agents: DataFrame, id_col: str, text_col: str, least: float = 0.8) -> DataFrame:
    """``agent_id, cluster_id, members, jaccard, cosine`` of agents in clusters of two or more: the least id of the cluster, its size, and the
    likeness to that one by sets of words and by TF-IDF.

    Ids are whole numbers and name one agent. Null and empty texts, and those without a word, are in no cluster. ``agents`` is read several times.
    """
    told = agents.select(F.col(id_col).cast("long").alias("agent_id"), F.col(text_col).alias("text"))
    all_ = minima(told)
    named = _stored(all_.groupBy("name").agg(F.min("agent_id").alias("set_id")), "names")
    sets = all_.join(named.select(F.col("set_id").alias("agent_id")), "agent_id").select(F.col("agent_id").alias("set_id"), "n", "bits", "hashes")
    found = components(links(told, sets, least))
    cluster = F.coalesce("component", "set_id").alias("cluster_id")
    of = all_.select("agent_id", "name").join(named, "name").join(found.withColumnRenamed("node", "set_id"), "set_id", "left").select("agent_id", cluster)
    sizes = of.groupBy("cluster_id").agg(F.count("*").alias("members")).where("members > 1")
    clusters = _stored(of.join(sizes, "cluster_id"), "clusters")
    return clusters.join(_to_first(told, clusters, all_.count()), "agent_id").select("agent_id", "cluster_id", "members", "jaccard", "cosine")


def _to_first(told: DataFrame, clusters: DataFrame, every: int) -> DataFrame:
    """``agent_id, jaccard, cosine`` to the first of the cluster; weights are counts of words times ln((agents + 1) / (agents that have it + 1)).

    A word that only one agent has needs no row in the table of how many have it.
    """
    held = _stored(told.select(F.explode(F.array_distinct(words("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df")).where("df > 1"), "held")
    members = _of(told, clusters.select("agent_id", "cluster_id"))
    leads = _of(told, clusters.where("agent_id = cluster_id").select("agent_id")).select(F.col("agent_id").alias("cluster_id"), F.col("text").alias("first_text"))
    counted = _shared(members.join(leads, "cluster_id").select("agent_id", "text", "first_text"))
    weighed = counted.join(_small(held, F.length("term") + 40), "term", "left").withColumn("idf", F.log(F.lit(every + 1.0) / (F.coalesce("df", F.lit(1)) + 1.0)))
    own, first = F.col("tf") * F.col("idf"), F.col("first_tf") * F.col("idf")
    sums = weighed.groupBy("agent_id").agg(
        F.sum(own * own).alias("own"), F.sum(first * first).alias("first"), F.sum(own * first).alias("dot"), F.count_if((F.col("tf") > 0) & (F.col("first_tf") > 0)).alias("common"), F.count("*").alias("either"),
    )
    cosine = F.coalesce(F.try_divide("dot", F.sqrt("own") * F.sqrt("first")), F.lit(0.0))
    return sums.select("agent_id", (F.col("common") / F.col("either")).alias("jaccard"), cosine.alias("cosine"))


def _shared(pairs: DataFrame) -> DataFrame:
    """``agent_id, term, tf, first_tf`` of each word in ``text`` or ``first_text``: the words of both are sorted together, so counts are the lengths of runs."""
    side = lambda text, k: F.transform(words(text), lambda w: F.struct(w.alias("term"), F.lit(k).alias("side")))
    sorted_ = pairs.select("agent_id", _once(F.sort_array(F.concat(side("text", 0), side("first_text", 1)))).alias("s"))
    starts = sorted_.select("agent_id", "s", _once(F.expr("filter(sequence(0, size(s) - 1), i -> i = 0 OR s[i] <> s[i - 1])")).alias("starts"))
    runs = starts.select("agent_id", _once(F.expr("transform(starts, (p, j) -> named_struct('term', s[p].term, 'side', s[p].side, 'n', coalesce(get(starts, j + 1), size(s)) - p))")).alias("runs"))
    told = "named_struct('term', r.term, 'tf', if(r.side = 0, r.n, 0), 'first_tf', CASE WHEN r.side = 1 THEN r.n WHEN get(runs, j + 1).term = r.term THEN get(runs, j + 1).n ELSE 0 END)"
    again = "r.side = 1 AND coalesce(get(runs, j - 1).term = r.term, false)"
    each = runs.select("agent_id", F.explode(F.expr(f"transform(runs, (r, j) -> if({again}, NULL, {told}))")).alias("w")).where("w IS NOT NULL")
    return each.select("agent_id", "w.term", "w.tf", "w.first_tf")

import collections
import math
import re

from pyspark.sql import functions as F

from fleetspark.llm import mixing


def targets(sizes, share=1.5, weights=(5, 2, 1), epochs=2):
    """Targets by sharing out the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left, base = total - sum(fixed.values()), sum(weight[s] for s in free)
        got = {s: left * weight[s] / base for s in free} if free else {}
        over = [s for s in free if got[s] > epochs * sizes[s]]
        if not over:
            return {**fixed, **got}
        fixed |= {s: float(epochs * sizes[s]) for s in over}


def test_mix_meets_its_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.taken_by_document(mixing.mix(docs, block_words=16, shard_blocks=200, bucket_rows=7)).collect()
    sizes = collections.Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    want, taken = targets(dict(sizes)), collections.Counter()
    assert len(rows) == docs.count()
    for r in rows:
        taken[r["source"]] += r["taken"]
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9) and r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixing.taken_by_document(mixing.mix(docs.repartition(5), block_words=16, shard_blocks=200, bucket_rows=7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_what_is_taken_as_a_plain_walk_takes(spark, sf_dir, monkeypatch):
    """Each source's documents in their permuted order, one after the other and once more, until the target is reached."""
    monkeypatch.setattr(mixing, "RUN_BUCKETS", 3)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.taken_by_document(mixing.mix(docs, block_words=16, shard_blocks=200, bucket_rows=7)).withColumn("h", F.xxhash64(F.lit(0), "doc_id", "size", "source")).collect()
    buckets, want = math.ceil(len(rows) / 7), {}
    for source in {r["source"] for r in rows}:
        own = sorted((r for r in rows if r["source"] == source), key=lambda r: (r["h"] % buckets, r["h"], r["doc_id"]))
        left = round(own[0]["target"])
        for r in [*own, *own]:
            take = min(left, r["size"])
            want[r["doc_id"]] = want.get(r["doc_id"], 0) + take
            left -= take
    assert {r["doc_id"]: r["taken"] for r in rows} == want


def test_a_tree_dealt_out_on_the_way_is_the_same(spark, monkeypatch):
    quotas = spark.createDataFrame([(0, 3000), (1, 1000), (2, 77)], "__mx_source int, quota long")
    plain = sorted(map(tuple, mixing.split_quotas(quotas, 40, seed=3).collect()))
    monkeypatch.setattr(mixing, "SPREAD_NODES", 4)
    assert sorted(map(tuple, mixing.split_quotas(quotas, 40, seed=3).collect())) == plain
    for source in range(3):  # shards take a source's blocks without gaps
        own = sorted((c for c in plain if c[0] == source), key=lambda c: c[1])
        assert all(a[2] + a[3] == b[2] for a, b in zip(own, own[1:])) and own[0][2] == 0


def test_blocks_are_disjoint_and_shards_even(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = mixing.mix(docs, block_words=16, shard_blocks=200).where("shard IS NOT NULL").collect()
    owner = {}
    for p in pieces:
        assert owner.setdefault((p["source"], p["block"]), p["shard"]) == p["shard"] and 0 < p["words"] <= 16
    per_shard = collections.Counter(owner.values())
    assert len(per_shard) > 20 and max(per_shard.values()) - min(per_shard.values()) <= 1


def test_the_tree_keeps_quotas_and_draws_fairly(spark):
    quotas = spark.createDataFrame([(0, 3000), (1, 1000), (2, 0), (3, 7)], "__mx_source int, quota long")
    cells = mixing.split_quotas(quotas, 8, seed=3).collect()
    by_source, by_shard = collections.Counter(), collections.Counter()
    for c in cells:
        by_source[c["__mx_source"]] += c["blocks"]
        by_shard[c["shard"]] += c["blocks"]
    assert by_source == {0: 3000, 1: 1000, 2: 0, 3: 7} and set(by_shard.values()) <= {500, 501}
    draws = [c["blocks"] for seed in range(12) for c in mixing.split_quotas(quotas, 2, seed).collect() if c["__mx_source"] == 1 and c["shard"] == 0]
    assert len(set(draws)) > 3 and abs(sum(draws) / len(draws) - 500) < 15  # the deviation of one draw is about 14


def test_odd_rows(spark):
    schema = "doc_id long, text string, source string, size int"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a b c", None, 0), (1, "a b c", None, 0), (2, None, "s", 0), (2, None, "s", 0), (None, "x y", "s", 0)]
    got = mixing.taken_by_document(mixing.mix(spark.createDataFrame(rows, schema))).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == [("1", 3), ("1", 3), ("2", 0), ("2", 0), ("None", 2)]
    assert sum(r["taken"] for r in got) == 12
    long = [(1, "w " * 300_000, "a", 0), (2, "x y", "a", 0), (3, "\u3000\u00a0 z", "b", 0)]
    found = {r["doc_id"]: r for r in mixing.taken_by_document(mixing.mix(spark.createDataFrame(long, schema))).collect()}
    assert found[1]["size"] == 300_000 and found[3]["size"] == 2 and all(r["taken"] <= 2 * r["size"] for r in found.values())
    assert abs(sum(r["taken"] for r in found.values()) - 450_006) <= 1


def test_shards_hold_the_words(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(30)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    pieces = mixing.mix(docs, block_words=16, shard_blocks=50)
    mixing.write_shards(docs, pieces, str(tmp_path / "out"))
    words = sum(len(r["text"].split(" ")) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert words == pieces.agg({"words": "sum"}).first()[0]

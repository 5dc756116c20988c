import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetspark.llm import repeats, suffix_array, suffix_trees
from tests.llm import brute

SCHEMA = "doc_id long, text string, spans string, __rp_id int"


def made(seed=1):
    """Texts with shared passages, copies, edits, empty ones and runs of one word."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    passages = [[word() for _ in range(rng.randint(40, 130))] for _ in range(6)]
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one two"), (4, "x " * 200), (5, "x " * 90), (6, "ab" * 700)]
    for i in range(7, 60):
        words = []
        for _ in range(rng.randint(1, 4)):
            words += rng.choice(passages) if rng.random() < 0.5 else [word() for _ in range(rng.randint(1, 80))]
        if rng.random() < 0.3:
            words[rng.randrange(len(words))] = "edited"
        rows.append((i, " ".join(words)))
    return rows + [(60, rows[20][1]), (61, rows[20][1]), (62, rows[4][1])]


@pytest.fixture(params=["memory", "hot"])
def tiers(request, monkeypatch):
    """With every group in memory, and with each tier of longer prefixes in use."""
    if request.param == "hot":
        monkeypatch.setattr(repeats, "TIERS", ((2, 0), (4, 8), (8, 64), (1 << 62, 1 << 30)))
        monkeypatch.setattr(repeats, "GROUP_BYTES", 2000)
    return request.param


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1) for i, t in rows], SCHEMA).repartition(3)


def test_words(spark, tiers):
    rows = made()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in suffix_trees.without_repeats(frame(spark, rows)).collect()}
    assert got == brute.repeats_of_words(rows)
    assert sum(v[1] for v in got.values()) > 1000


def test_bytes(spark, tiers):
    rows = made(2)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_array.without_repeats(frame(spark, rows)).collect()}
    assert got == brute.repeats_of_bytes(rows)


def test_slabs_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SLAB", 64)
    rows = made(3)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in suffix_trees.without_repeats(frame(spark, rows)).collect()}
    assert got == brute.repeats_of_words(rows)


def test_slabs_change_nothing_for_bytes(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SLAB", 150)
    rows = made(4)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_array.without_repeats(frame(spark, rows)).collect()}
    assert got == brute.repeats_of_bytes(rows)


def test_empty_table_null_ids_and_repeated_rows(spark):
    assert suffix_trees.without_repeats(frame(spark, [])).count() == 0
    assert suffix_array.without_repeats(frame(spark, [])).count() == 0
    text = " ".join(f"w{i}" for i in range(120))
    words = suffix_trees.without_repeats(frame(spark, [(5, text), (5, text), (None, text)])).collect()
    assert [r["n_removed"] for r in words] == [0, 0, 0]
    found = suffix_array.without_repeats(frame(spark, [(5, text), (5, text), (None, text)])).collect()
    assert sorted(r["n_removed"] for r in found) == [0, len(text), len(text)]


def contents(seed=0, count=30, letters=2):
    rng = np.random.default_rng(seed)
    return [bytes(rng.integers(97, 97 + letters, rng.integers(20, 90), np.uint8)) for _ in range(count)]


def same(ids, owner, place, window):
    seen = {}
    for i, o, p in zip(ids.tolist(), owner.tolist(), place.tolist()):
        assert seen.setdefault(window(o, p), i) == i
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("length,gram,together", [(12, 4, 1 << 17), (12, 4, 7), (5, 5, 50), (40, 5, 16)])
def test_a_suffix_array_puts_equal_windows_together(monkeypatch, length, gram, together):
    monkeypatch.setattr(suffix_array, "TOGETHER", together)
    found = contents() + [b"ab" * 40, b"ab" * 41, b"a" * 60, b"", b"abc"]
    found += [found[3][5:] + b"b", b"b" + found[3]]
    same(*suffix_array.array_index(found, np.zeros(len(found), int), length, gram), lambda o, p: found[o][p : p + length])
    with pytest.raises(ValueError):
        suffix_array.SuffixArray(found, length + 1, 4 if gram == 4 else gram)


@pytest.mark.parametrize("read", [1, 1 << 21])
def test_suffix_trees_have_all_nodes(monkeypatch, read):
    monkeypatch.setattr(suffix_trees, "READ_WORDS", read)
    texts = [" ".join(chr(b) for b in c).encode() for c in contents(1)]
    texts += [texts[4][8:], b"x " + texts[4], b" ".join([b"a"] * 40), b"", b"a b"]
    groups = np.arange(len(texts)) // 9
    words = [t.split() for t in texts]
    same(*suffix_trees.tree_index(texts, groups, 6), lambda o, p: (groups[o], *words[o][p : p + 6]))
    trees = suffix_trees.SuffixTrees(texts, groups, 6)
    suffixes = [(groups[o], *words[o][p:], ("end", o)) for o, p in zip(trees.owner, trees.place)]
    ordered = [suffixes[i] for i in trees.leaves]

    def shared(a, b):
        return next(k for k in range(len(a)) if a[k] != b[k]) - 1

    assert [shared(a, b) for a, b in zip(ordered, ordered[1:])] == trees.branch[1:].tolist()
    # a node is a prefix that goes on in several ways
    ways = {}
    for s in suffixes:
        for k in range(7, len(s)):
            ways.setdefault(s[:k], set()).add(s[k])
    want = sorted(len(prefix) - 1 for prefix, then in ways.items() if len(then) > 1)
    found = trees.nodes(6)
    assert sorted(depth for depth, _, _ in found) == want
    for depth, first, last in found:
        assert len({s[: depth + 1] for s in ordered[first : last + 1]}) == 1


def test_ids_are_numbers(spark):
    docs = spark.createDataFrame([("7", "a b"), ("8", None)], "doc_id string, text string")
    assert {r["doc_id"] for r in suffix_trees.without_repeats(docs).collect()} == {7, 8}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        suffix_array.without_repeats(docs.withColumn("doc_id", F.concat(F.lit("x"), "doc_id"))).collect()

import collections
import random

import numpy as np
import pytest

from fleetspark.llm import graph, ngram_join
from tests.llm import brute


def made(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(0, None), (1, ""), (2, "One"), (3, "oNE"), (4, "a b"), (5, "a a a a a"), (6, "A a")]
    base = [rng.choice(vocabulary) for _ in range(120)]
    for i in range(7, 90):
        if rng.random() < 0.3:
            base = [rng.choice(vocabulary) for _ in range(rng.randint(5, 150))]
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, "\n".join(words) if i % 2 else " ".join(words).upper()))
    return rows


@pytest.mark.parametrize(
    "n,percent,cell,star,most",
    [(3, 90, ngram_join.CELL_SHINGLES, 2000, 1 << 25), (5, 80, ngram_join.CELL_SHINGLES, 3, 0), (3, 80, 200, 2, 1 << 25), (3, 60, 600, 1, 0)],
)
def test_against_all_pairs(spark, n, percent, cell, star, most):
    rows = made(n + percent)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, size int, component string").repartition(3)
    found = ngram_join.alike(docs, n, percent, cell_shingles=cell, star_sets=star, broadcast_bytes=most)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}
    assert got == brute.alike(rows, n, percent)


def test_very_long_texts(spark):
    """Two texts of 60,000 words that differ in one, a part of them, and short ones."""
    rng = random.Random(9)
    words = [f"w{rng.randrange(30_000)}" for _ in range(60_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1] + ["other"])), (3, " ".join(words[:20_000])), (4, " ".join(words[:30])), (5, " ".join(words[:30]) + " x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.alike(docs, 3, 90).collect()}
    assert got == brute.alike(rows, 3, 90) and got[2][1] == 1 and got[3][1] == 3


def test_the_heap_merge_counts_as_a_plain_count():
    rng = random.Random(3)
    for _ in range(300):
        lists = [sorted(rng.sample(range(30), rng.randint(0, 20))) for _ in range(rng.randint(1, 9))]
        least = rng.randint(1, 6)
        counts = collections.Counter(d for own in lists for d in own)
        assert ngram_join.occurring(lists, least) == sorted((d, c) for d, c in counts.items() if c >= least)


def test_cells_link_as_all_pairs_do():
    """Chains: neighbours are alike, others are not; whatever is joined before, the groups come out the same."""
    rng = np.random.default_rng(1)
    sets = [np.arange(i * 5, i * 5 + 100) for i in range(40)] + [np.sort(rng.choice(10_000, 60, False)) + 100_000 for _ in range(20)]
    sets += [np.append(sets[45], 7), sets[50][1:]]

    def parts(links, groups=None):
        parent = list(range(len(sets))) if groups is None else [int(np.flatnonzero(groups == g)[0]) for g in groups]
        root = lambda x: x if parent[x] == x else root(parent[x])
        for a, b in links:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
        return [root(x) for x in range(len(sets))]

    want = parts([(i, j) for i in range(len(sets)) for j in range(i) if 10 * len(np.intersect1d(sets[i], sets[j])) >= 9 * len(np.union1d(sets[i], sets[j]))])
    assert len(set(want)) == 21
    assert parts(ngram_join.Cell(sets, 90).links()) == want
    joined = np.arange(len(sets))
    joined[:10] = 0
    assert parts(ngram_join.Cell(sets, 90, groups=joined).links(), joined) == want


def test_cases_without_an_answer(spark):
    schema = "doc_id long, text string"
    assert ngram_join.alike(spark.createDataFrame([], schema)).count() == 0
    rows = [(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (2, "a b c d"), (None, None)]
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in ngram_join.alike(spark.createDataFrame(rows, schema)).collect())
    assert got == [("2", 1, "2"), ("3", 1, "2"), ("3", 1, "2"), ("None", 0, "None"), ("None", 1, "2")]


def test_rows_that_share_an_id_are_one_node(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(i % 4, " ".join(base[: 30 + i % 4] + [f"x{i % 4}"] + base[30 + i % 4 :])) for i in range(12)]
    found = {(r["doc_id"], r["component_id"]) for r in ngram_join.alike(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80, star_sets=1).collect()}
    assert found == {(i, 0) for i in range(4)}


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(100))
    docs = spark.createDataFrame([(1, text + " x", "q"), (2, text, "q"), (3, "other words", "q"), (None, text, "q")], "doc_id long, text string, lang string")
    kept = ngram_join.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 3, None}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, j) for j in range(101, 130)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{j: 100 for j in range(100, 130)}}

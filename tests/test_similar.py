import random

from fleetspark.operators import similar


def jaccard(a, b):
    return len(a & b) / len(a | b)


def reachable(sets, least):
    """Cluster of each agent by all pairs."""
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                if label[i] != label[j] and jaccard(sets[i], sets[j]) >= least:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def test_planted_copies_are_found_and_others_are_not(spark):
    """Recall of near copies against all pairs: every agent is in the cluster that all pairs give it."""
    rng = random.Random(5)
    vocabulary = [f"word{i}" for i in range(900)]
    texts = {}
    for base in range(25):
        prompt = [rng.choice(vocabulary) for _ in range(60)]
        for copy in range(rng.randint(1, 5)):
            edited = [w for w in prompt if rng.random() > 0.03 * copy] + [rng.choice(vocabulary) for _ in range(copy)]
            texts[len(texts)] = " ".join(edited) if copy % 2 else " ".join(edited).upper() + "!"
    rows = [(i, t) for i, t in texts.items()] + [(900, None), (901, ""), (902, "..."), (903, texts[0]), (904, "one"), (905, "One.")]
    got = {r["agent_id"]: r for r in similar.near_duplicates(spark.createDataFrame(rows, "id int, text string"), "id", "text").collect()}
    sets = {i: set(t.lower().replace("!", "").replace(".", "").split()) for i, t in rows if t and set(t) != {"."}}
    label = reachable(sets, 0.8)
    want = {i: label[i] for i in sets if sum(v == label[i] for v in label.values()) > 1}
    assert {i: r["cluster_id"] for i, r in got.items()} == want and len(want) > 30
    assert all(abs(r["jaccard"] - jaccard(sets[i], sets[r["cluster_id"]])) < 1e-9 and 0 < r["cosine"] < 1 + 1e-9 for i, r in got.items())
    assert got[903]["jaccard"] == 1 and abs(got[903]["cosine"] - 1) < 1e-9 and got[904]["members"] == 2


def test_chains_and_empty_tables(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["component"] for r in similar.components(edges).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100}
    assert similar.near_duplicates(spark.createDataFrame([], "id long, text string"), "id", "text").count() == 0


def _held(path):
    return sum(p.stat().st_size for p in path.rglob("*.parquet"))


def test_texts_are_not_stored_again(spark, tmp_path, monkeypatch):
    """Texts that nothing resembles leave their minima behind and no words: the intermediate tables are less than half the texts."""
    monkeypatch.setattr(similar, "folder", lambda spark, name: str(tmp_path / f"{name}-{len(list(tmp_path.iterdir()))}"))
    rng = random.Random(6)
    texts = [" ".join(f"{rng.getrandbits(64):x}" for _ in range(1500)) for _ in range(60)]
    rows = list(enumerate(texts)) + [(100, texts[7] + " more"), (101, texts[9])]
    got = similar.near_duplicates(spark.createDataFrame(rows, "id long, text string"), "id", "text").collect()
    assert sorted((r["agent_id"], r["cluster_id"]) for r in got) == [(7, 7), (9, 9), (100, 7), (101, 9)]
    assert 0 < _held(tmp_path) < sum(map(len, texts)) / 2


def test_words_of_two_texts_are_counted_together(spark):
    rows = spark.createDataFrame([(1, "b a b, B c", "a b d d"), (2, "x", "x x"), (3, "q", "r")], "agent_id long, text string, first_text string")
    got = {(r["agent_id"], r["term"]): (r["tf"], r["first_tf"]) for r in similar._shared(rows).collect()}
    assert got == {(1, "a"): (1, 1), (1, "b"): (3, 1), (1, "c"): (1, 0), (1, "d"): (0, 2), (2, "x"): (1, 2), (3, "q"): (1, 0), (3, "r"): (0, 1)}

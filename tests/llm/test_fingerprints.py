import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from fleetspark.llm import fingerprints as fp
from fleetspark.llm.queries import queries


def words(seed, count):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(count))


def test_interior_phrases_don_t_depend_on_offset():
    shared = words(1, 300)
    a, b = fp.parse([(words(2, 40) + shared).encode()])[0], fp.parse([("é" + words(3, 77) + shared + words(4, 9)).encode()])[0]
    alone = fp.parse([shared.encode()])[0]
    inner = set(alone[4:-4].tolist())
    assert inner <= set(a.tolist()) and inner <= set(b.tolist())


def plain_parse(data, level):
    """One text, name by name, as the module's text says."""
    mask, step = (1 << 64) - 1, int(fp._STEP)

    def mixed(x):
        x = ((x ^ x >> 30) * int(fp._MIX1)) & mask
        x = ((x ^ x >> 27) * int(fp._MIX2)) & mask
        return x ^ x >> 31

    def tossed(left, right):
        place = ((left ^ right) & -(left ^ right)).bit_length() - 1
        return 2 * place + (right >> place & 1)

    names = list(data)
    for _ in range(level):
        runs = []
        for name in names:
            if runs and runs[-1][0] == name:
                runs[-1][1] += 1
            else:
                runs.append([name, 1])
        labels = [name for name, _ in runs]
        for _ in range(4):
            labels = [labels[0] & 1] + [tossed(a, b) for a, b in zip(labels, labels[1:])]
        wide = [mixed((name + length * step) & mask) if length > 1 else name for name, length in runs]
        phrases = []
        for i, name in enumerate(wide):
            if i == 0 or 1 < i < len(wide) - 1 and labels[i - 1] < labels[i] > labels[i + 1]:
                phrases.append([])
            phrases[-1].append(name)
        names = [mixed((sum(mixed((n + (k + 1) * step) & mask) for k, n in enumerate(p)) + len(p)) & mask) for p in phrases]
    return names


def test_parsing_as_a_plain_loop_does():
    texts = [words(i, i * 4).encode() for i in range(1, 25)] + [b"a", b"ab", b"aaaa", b"aab" * 9, "é漢".encode() * 30]
    for level in (1, 2, 3):
        names, owner = fp.parse(texts, level)
        for i, t in enumerate(texts):
            assert names[owner == i].tolist() == plain_parse(t, level), (level, t)


def test_batches_don_t_matter_and_phrases_are_short():
    texts = [words(i, i * 3) for i in range(40)] + ["", "a", "aaaa" * 500, "ab" * 300]
    together = fp.sketch(texts)
    assert all((fp.sketch([t])[0] == together[i]).all() for i, t in enumerate(texts))
    names, _ = fp.parse([texts[39].encode()], 1)
    assert len(texts[39]) / 11 <= len(names) <= len(texts[39]) / 2


def test_likeness():
    a = words(5, 600)
    near = fp.likeness(fp.sketch([a, a, "", "", "x"]), fp.sketch([a, a[: len(a) * 3 // 4] + words(6, 200), "", "y", words(7, 600)]))
    assert near[0] == 1 and 0.3 < near[1] < 0.9 and near[2] == 1 and near[3] == 0 and near[4] < 0.1


def test_edits_against_a_plain_loop(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r for r in fp.with_edits(docs, range_rows=30).collect()}
    rows = sorted(map(tuple, docs.collect()))
    assert len(got) == len(rows)
    for (id_, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        own, other, next_ = fp.sketch([text]), fp.sketch([edited]), fp.sketch([following])
        assert got[id_]["n_chars"] == len(text) and got[id_]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[id_]["fingerprint"] == fp.written(own)[0] and got[id_]["edited_fingerprint"] == fp.written(other)[0]
        assert np.isclose(got[id_]["near_edited"], fp.likeness(own, other)[0]) and np.isclose(got[id_]["near_next"], fp.likeness(own, next_)[0])
    assert queries()["op2_fingerprints"](spark, sf_dir).count() == len(rows)


def test_odd_rows(spark):
    schema = "doc_id long, text string, range string, ahead int"
    assert fp.with_edits(spark.createDataFrame([], schema)).count() == 0
    one = fp.with_edits(spark.createDataFrame([(1, "abcd", "", 0)], schema)).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abca").hexdigest() and one["near_next"] == 1
    rows = [(2, "same", "", 0), (2, "same", "", 0), (None, None, "", 0), (1, "", "", 0), (7, "x" * 100_000, "", 0)]
    got = fp.with_edits(spark.createDataFrame(rows, schema).repartition(3), range_rows=1).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 0, 4, 4, 100_000]
    assert spark.createDataFrame(rows, schema).select(fp.fingerprint(F.col("text")).alias("f")).distinct().count() == 3

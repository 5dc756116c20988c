import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from fleetspark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.Tokenizer(bpe.load_ranks(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


PARTS = ["a", "b", " ", "  ", "\n", "é", "'s", "'", "1", "23", " the", "\t", "!", "　", "漢", "\x85", "\x1c", "ing", "<|endoftext|>", "\U0001f600"]


def texts(count, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 16))) for _ in range(count)]


def packed(reference, text):
    return np.array(reference.encode_ordinary(text), "<u4").tobytes()


def test_as_the_library_encodes(tokenizer, reference):
    for text in texts(4000):
        ids = tokenizer.encode(text)
        assert ids == packed(reference, text) and tokenizer.decode(ids) == text.encode()


def test_learning_a_batch_changes_nothing(reference):
    fresh = bpe.Tokenizer(bpe.load_ranks(PATH), public_tokenizers.PATTERN)
    batch = texts(500, 2) + ["unbelievably rethinking rethink re", ""]
    fresh.learn_short(batch)
    assert all(fresh.encode(t) == packed(reference, t) for t in batch)


def test_slabs_and_full_caches_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "SLAB", 5)
    monkeypatch.setattr(bpe, "CACHE_BYTES", 2000)
    monkeypatch.setattr(bpe, "CACHE_PAIRS", 50)
    fresh = bpe.Tokenizer(bpe.load_ranks(PATH), public_tokenizers.PATTERN)
    for text in [*texts(800, 6), "the quick brown fox  jumps over the lazy dog " * 40, "x" * 300]:
        ids, raw = packed(reference, text), text.encode()
        assert fresh.encode(text) == ids and fresh.digests(text) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(raw).hexdigest())
        assert fresh.decoded_sha256(ids) == hashlib.sha256(raw).hexdigest()
        assert len(fresh.vocabulary.follows) <= 50 and fresh.behind_space.held < 5000


def test_a_long_piece(tokenizer, reference):
    text = "".join(random.Random(3).choice("abcde") for _ in range(3000)) + " " * 500 + "x"
    assert tokenizer.encode(text) == packed(reference, text)


def test_prefixes_appends_and_replacements(tokenizer):
    v, data = tokenizer.vocabulary, b"internationalization of tokens"
    table = bpe.PrefixTable(v)
    for i in range(len(data)):
        table.append(data[i : i + 1])
        assert table.ids() == v.merged(data[: i + 1])
    assert all(table.ids(i) == v.merged(data[:i]) for i in range(len(data)))
    table.replace(5, 13, b"nesi")
    assert table.ids() == v.merged(b"internesi" + data[13:])


def test_edits_of_a_text(tokenizer):
    rng = random.Random(5)
    for text in texts(300, 4):
        edited = bpe.EncodedText(tokenizer, text)
        for _ in range(3):
            a = rng.randint(0, len(edited.text))
            b, new = rng.randint(a, min(len(edited.text), a + 4)), "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 3)))
            want = edited.text[:a] + new + edited.text[b:]
            edited.replace(a, b, new)
            assert edited.text == want and edited.ids() == tokenizer.encode(want)
    long = bpe.EncodedText(tokenizer, "word " * 500)
    long.replace(1000, 1001, "W")
    assert long.reencoded < 8


def test_columns(spark, reference):
    rows = [(None,), ("",), ("Hello  world\n",)]
    got = spark.createDataFrame(rows, "text string").select("text", bpe.encoded(F.col("text"), PATH, public_tokenizers.PATTERN).alias("e")).collect()
    assert [r["e"]["n_tokens"] for r in got] == [0, 0, 4]
    assert got[2]["e"]["ids"] == reference.encode_ordinary("Hello  world\n") and got[2]["e"]["decoded_sha256"] == hashlib.sha256(b"Hello  world\n").hexdigest()


def test_odd_tables(spark):
    assert spark.createDataFrame([], "text string").select(bpe.digests(F.col("text"), PATH, public_tokenizers.PATTERN)).count() == 0
    rows = [("a b", 1, "x"), ("a b", 1, "x"), (None, None, None)]
    got = spark.createDataFrame(rows, "text string, ids int, n_tokens string").select(bpe.encoded(F.col("text"), PATH, public_tokenizers.PATTERN).alias("e"), "ids", "n_tokens").collect()
    assert [(r["e"]["n_tokens"], r["ids"], r["n_tokens"]) for r in got] == [(2, 1, "x"), (2, 1, "x"), (0, None, None)]


def test_a_narrower_bound_drops_what_was_kept_and_changes_nothing(reference):
    texts = [" ".join(f"word{i * j}" for j in range(40)) for i in range(60)]
    pattern = public_tokenizers.PATTERN
    wide = bpe.Tokenizer.of(PATH, pattern, 1 << 20)
    before = [wide.encode(t) for t in texts]
    narrow = bpe.Tokenizer.of(PATH, pattern, 4000)
    assert narrow is wide and not narrow.behind_space and not narrow.behind_space.old
    assert [narrow.encode(t) for t in texts] == before
    assert narrow.behind_space.held < 4000
    assert [np.frombuffer(b, "<u4").tolist() for b in before] == [reference.encode_ordinary(t) for t in texts]
    assert bpe.Tokenizer.of(PATH, pattern).behind_space.most == bpe.CACHE_BYTES

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fleetspark.llm import alignment, chunks

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "it", "'s", "'", " ", " ", "  ", "\n", "\t", "é", "é", "́", "▁", "1", "23", "<|endoftext|>", "</s>", "<0x41>", "漢字", "\x85", "\xa0", "\x1c", "!?", "ing", "\U0001f600", "straße", "=====", "qzx"]


@pytest.fixture(scope="module")
def plain():
    """Groups of a text by sets of ends, from whole texts encoded by the libraries."""
    a, b, letters = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), alignment.byte_letters()
    a.encode_special_tokens = True

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a, bytes_b = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a], [piece(i) for i in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        found, low = [], 0
        for end in sorted(set(ends_a) & set(ends_b)):
            found.append(([i for i, e in zip(ids_a, ends_a) if low < e <= end], [i for i, e in zip(ids_b, ends_b) if low < e <= end]))
            low = end
        return found

    return groups


def plain_rows(groups_of_texts):
    linked = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in groups_of_texts]
    held = Counter(p for c in linked for p in c)
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    rows = []
    for groups, c in zip(groups_of_texts, linked):
        written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        rows.append((
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(c.values()),
            sum(n for p, n in c.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in c.items()), hashlib.sha256(written.encode()).hexdigest() if groups else "",
        ))
    return rows


def texts(count, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(count)]


@pytest.mark.parametrize(("slab", "kept", "expand"), [(1 << 20, 1 << 26, 1 << 22), (9, 3000, 3)])
def test_documents_as_sets_of_ends_give_them(plain, monkeypatch, slab, kept, expand):
    monkeypatch.setattr(chunks, "SLAB", slab)
    monkeypatch.setattr(chunks, "KEPT_BYTES", kept)
    monkeypatch.setattr(alignment, "EXPAND", expand)
    pair, batch = alignment.Pair(A, B), texts(1500)
    got = [x for at in range(0, len(batch), 50) for x in pair.documents(batch[at : at + 50])]
    some = 0
    for text, x in zip(batch, got):
        groups = plain(text)
        (row,) = plain_rows([groups])
        assert (tuple(x.counts), x.groups_sha256) == (row[:4], row[6]), repr(text)
        want = Counter((i * pair.width + j) for a, b in groups for i in a for j in b)
        assert dict(zip(x.keys.tolist(), x.times.tolist())) == want and len(x.keys) == len(want)
        some += bool(groups)
    assert 500 < some < 1500


def test_a_large_group_is_expanded_in_slices(monkeypatch):
    monkeypatch.setattr(alignment, "EXPAND", 1000)
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 40, 3000), rng.integers(0, 60, 5000)
    owner, keys, times = alignment.linked_pairs(np.zeros(3000, np.int64), a, np.zeros(3000, np.int64), b, np.zeros(5000, np.int64), 60)
    want = Counter({(x * 60 + y): n * m for x, n in Counter(a.tolist()).items() for y, m in Counter(b.tolist()).items()})
    assert dict(zip(keys.tolist(), times.tolist())) == want and not owner.any() and times.sum() == 15_000_000


ROWS = [(1, None, "x"), (2, "", "x"), (3, "The quick brown fox", "y"), (3, "The quick brown fox", "y"), (None, "jumps over the lazy dog 123", "z"), (4, "a▁b", "z"), (5, "naïve straße " * 3000, "z")]
ROWS += [(10 + i, t, "w") for i, t in enumerate(["in the end", "the end of it", "  the\n\nend", "The quick brown cat", "<|endoftext|> the end"])]


@pytest.mark.parametrize(("row_pairs", "heavy"), [(1 << 16, 1 << 16), (3, 12)])
def test_a_table(spark, plain, monkeypatch, row_pairs, heavy):
    monkeypatch.setattr(alignment, "ROW_PAIRS", row_pairs)
    monkeypatch.setattr(alignment, "HEAVY", heavy)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, row string").withColumnRenamed("row", "pairs")
    aligned = alignment.align(docs, A, B)
    got = alignment.with_counts(aligned, alignment.pair_counts(aligned)).collect()
    want = [(i, *row) for (i, *_), row in zip(ROWS, plain_rows([plain(t or "") for _, t, _ in ROWS]))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_an_empty_table(spark):
    aligned = alignment.align(spark.createDataFrame([], "doc_id string, text string"), A, B)
    assert alignment.with_counts(aligned, alignment.pair_counts(aligned)).count() == 0

"""Byte-level BPE by prefix dynamic programming.

For each prefix of a piece of bytes there is one token that its encoding ends with. It is the only token that is a suffix
of the prefix and that may follow the last token of the rest, where two tokens may follow one another if BPE leaves their
joined bytes as these two. ``PrefixTable`` stores that token for each prefix: appending bytes only adds entries, and an
edit keeps those before it. ``EncodedText`` keeps a text's chunks and re-encodes those that an edit touches.

A text is cut by the tokenizer's pattern first. Cutting at single spaces beforehand changes nothing, as no match holds a
space behind another character unless white space surrounds it; so chunks between such spaces are looked up in a bounded
cache of each worker, and only new ones are encoded. A long text is cut into slabs at such spaces, so a worker holds the ids
of one batch and the tables of one slab. Defined cases: null is empty; an empty text has no tokens; any length works, in
time linear in it. Every row is on its own: no shuffle.

A chunk of one space and letters is one piece of the pattern; this shortcut is right for patterns that, like byte-level
BPE's usual ones, match an optional space and a run of letters first.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of encoded chunks, and pairs of tokens, that a worker keeps. Of full chunks the older half goes, full pairs go.
CACHE_BYTES, CACHE_PAIRS = 240 << 20, 400_000
#: What an entry takes beside its characters, about.
_ENTRY = 250
#: Characters of a text that are cut into chunks at once.
SLAB = 1 << 20

_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_TWO_SPACES = re.compile(r"\s\s")


def load_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file of base64 tokens and numbers."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Vocabulary:
    """Ranks, and which tokens may follow one another."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        #: Lengths, from long to short, of the tokens that end in four given bytes; tokens of up to three are tried besides.
        self.ending: dict[bytes, list[int]] = {}
        for token in sorted(ranks, key=len, reverse=True):
            if len(token) > 3 and len(token) not in (known := self.ending.setdefault(token[-4:], [])):
                known.append(len(token))
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.follows: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        ordered = [self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)]
        self.lengths = np.array([len(t) for t in ordered], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.bytes = np.frombuffer(b"".join(ordered), np.uint8)

    def merged(self, data: bytes) -> list[int]:
        """BPE by its definition: the adjacent pair of lowest rank, leftmost first, is joined until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if best[0] == 1 << 60:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return [self.ranks[p] for p in parts]

    def may_follow(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) >= CACHE_PAIRS:
                self.follows.clear()
            known = self.follows[key] = self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
        return known

    def stands(self, token: int) -> bool:
        known = self.alone.get(token)
        if known is None:
            known = self.alone[token] = self.merged(self.tokens[token]) == [token]
        return known

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of tokens, by one gather."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(self.starts[ids] - (ends - lengths), lengths) + np.arange(total)
        return self.bytes[places].tobytes()


class PrefixTable:
    """For each prefix of a piece, the last token of its encoding."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        all_, last, v = self.data, self.last, self.vocabulary
        get, follows, may_follow, ending = v.ranks.get, v.follows, v.may_follow, v.ending
        for end in range(len(last) + 1, len(all_) + 1):
            for length in (*ending.get(all_[end - 4 : end] if end > 3 else b"", ()), 3, 2, 1):
                start = end - length
                if start < 0 or (token := get(all_[start:end])) is None:
                    continue
                if start:
                    left = last[start - 1]
                    known = follows.get(left << 32 | token)
                    if known or known is None and may_follow(left, token):
                        break
                elif v.stands(token):
                    break
            else:
                raise ValueError("the vocabulary lacks a byte of the text")
            last.append(token)

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Bytes [start, end) become ``data``; entries before ``start`` stay."""
        tail = data + self.data[end:]
        self.data, self.last = self.data[:start], self.last[:start]
        self.append(tail)

    def become(self, data: bytes) -> None:
        """Change the piece to ``data``; entries of the prefix that both share stay."""
        old, shared = self.data, 0
        for a, b in zip(old, data):
            if a != b:
                break
            shared += 1
        self.data, self.last = old[:shared], self.last[:shared]
        self.append(data[shared:])

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of the piece, or of its first ``end`` bytes."""
        at, found = len(self.data) if end is None else end, []
        while at:
            token = self.last[at - 1]
            found.append(token)
            at -= len(self.vocabulary.tokens[token])
        return found[::-1]


class _Chunks(dict):
    """Encodings of chunks, as bytes of little-endian 32-bit ids, up to ``most`` bytes."""

    def __init__(self, encode, prefix: str, most: int):
        super().__init__()
        self.encode, self.prefix, self.most, self.held, self.old = encode, prefix, most, 0, {}

    def bound(self, most: int) -> None:
        """Keep up to ``most`` bytes from now on; what was kept under a wider bound goes."""
        if most < self.most:
            self.clear()
            self.held, self.old = 0, {}
        self.most = most

    def __missing__(self, chunk: str) -> bytes:
        found = self.old.get(chunk)
        if found is None:
            found = self.encode(self.prefix + chunk)
        self.put(chunk, found)
        return found

    def put(self, chunk: str, ids: bytes) -> None:
        if self.held > self.most // 2:
            self.old = dict(self)
            self.clear()
            self.held = 0
        self.held += len(chunk) + len(ids) + _ENTRY
        self[chunk] = ids


class Tokenizer:
    """Encoding and decoding with one vocabulary and pattern; ``cache_bytes`` bounds the chunks kept and changes no result."""

    _made: dict[tuple[str, str], "Tokenizer"] = {}

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache_bytes: int | None = None):
        self.vocabulary = Vocabulary(ranks)
        self.pattern = regex.compile(pattern)
        self.behind_space = _Chunks(self.encode_chunk, " ", CACHE_BYTES if cache_bytes is None else cache_bytes)

    @classmethod
    def of(cls, path: str, pattern: str, cache_bytes: int | None = None) -> "Tokenizer":
        if (path, pattern) not in cls._made:
            cls._made[path, pattern] = cls(load_ranks(path), pattern, cache_bytes)
        found = cls._made[path, pattern]
        found.behind_space.bound(CACHE_BYTES if cache_bytes is None else cache_bytes)
        return found

    def encode_chunk(self, chunk: str) -> bytes:
        ranks, ids = self.vocabulary.ranks, []
        for piece in self.pieces(chunk):
            data = piece.encode()
            whole = ranks.get(data)
            ids += [whole] if whole is not None and self.vocabulary.stands(whole) else PrefixTable(self.vocabulary, data).ids()
        return np.array(ids, "<u4").tobytes()

    def learn(self, chunks: Iterable[str]) -> None:
        """Encode the new ones of chunks behind spaces in sorted order, in one table: neighbours share most of their prefixes."""
        known, table = self.behind_space, PrefixTable(self.vocabulary)
        fresh = {c: self.pieces(" " + c) for c in set(chunks) if c not in known and c not in known.old}
        made = {}
        for piece in sorted({p.encode() for pieces in fresh.values() for p in pieces}):
            table.become(piece)
            made[piece] = np.array(table.ids(), "<u4").tobytes()
        for chunk, pieces in fresh.items():
            known.put(chunk, b"".join([made[p.encode()] for p in pieces]))

    def pieces(self, chunk: str) -> list[str]:
        return [chunk] if chunk[:1] == " " and chunk[1:].isalpha() else self.pattern.findall(chunk)

    def chunks(self, text: str) -> list[str]:
        """Chunks whose encodings, joined, are the text's; all but the first lost a space before them."""
        return _SAFE_SPACE.split(text) if _TWO_SPACES.search(text) else text.split(" ")

    def slabs(self, text: str) -> Iterator[tuple[bool, str]]:
        """Stretches of a text between safe spaces, and whether the space before each is left out of it."""
        at, behind = 0, False
        while len(text) - at > SLAB and (space := _SAFE_SPACE.search(text, at + SLAB)):
            yield behind, text[at : space.start()]
            at, behind = space.end(), True
        yield behind, text[at:]

    def encoded_slabs(self, text: str) -> Iterator[bytes]:
        """The encodings of a text's slabs, one after the other."""
        for behind, slab in self.slabs(text) if text else ():
            first, *others = self.chunks(slab)
            if len(others) > 2000:
                self.learn(others)
            head = self.behind_space[first] if behind else self.encode_chunk(first)
            yield head + b"".join(map(self.behind_space.__getitem__, others))

    def encode(self, text: str) -> bytes:
        return b"".join(self.encoded_slabs(text))

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, SHA-256 of the ids and of the bytes that they decode to, slab by slab."""
        count, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for slab in self.encoded_slabs(text):
            count += len(slab) // 4
            ids.update(slab)
            decoded.update(self.decode(slab))
        return count, ids.hexdigest(), decoded.hexdigest()

    def learn_short(self, texts: Iterable[str]) -> None:
        """``learn`` the chunks of all texts of one slab, up to a slab's characters at a time."""
        held, chunks = 0, []
        for text in texts:
            if len(text) <= SLAB:
                held += len(text)
                chunks += self.chunks(text)[1:]
            if held > SLAB:
                self.learn(chunks)
                held, chunks = 0, []
        self.learn(chunks)

    def decode(self, ids: bytes) -> bytes:
        return self.vocabulary.decode(np.frombuffer(ids, "<u4"))

    def decoded_sha256(self, ids: bytes) -> str:
        found = hashlib.sha256()
        for at in range(0, len(ids), 4 * SLAB):
            found.update(self.decode(ids[at : at + 4 * SLAB]))
        return found.hexdigest()


class EncodedText:
    """A text with the encodings of its chunks: appends and edits re-encode only the chunks they touch."""

    def __init__(self, tokenizer: Tokenizer, text: str = ""):
        self.tokenizer, self.text, self.reencoded = tokenizer, "", 0
        self.parts: list[tuple[str, bytes]] = []
        self.replace(0, 0, text)

    def replace(self, start: int, end: int, new: str) -> None:
        kept_from, at, first, last = 0, 0, 0, len(self.parts)
        for i, (chunk, _) in enumerate(self.parts):  # the chunks that hold a character next to the edit
            if at + len(chunk) < start:
                first, kept_from = i + 1, at + len(chunk)
            if at > end and last == len(self.parts):
                last = i
            at += len(chunk)
        until = sum(len(c) for c, _ in self.parts[:last])
        # white space runs may join across a chunk's edge, so one more chunk on either side is redone
        if first:
            first -= 1
            kept_from -= len(self.parts[first][0])
        if last < len(self.parts):
            until += len(self.parts[last][0])
            last += 1
        region = self.text[kept_from:start] + new + self.text[end:until]
        pieces = self.tokenizer.chunks(region) if region else []
        chunks = [c if i == 0 else " " + c for i, c in enumerate(pieces)]
        chunks = [c for c in chunks if c]
        self.parts[first:last] = [(c, self.tokenizer.encode_chunk(c)) for c in chunks]
        self.reencoded = len(chunks)
        self.text = self.text[:start] + new + self.text[end:]

    def append(self, new: str) -> None:
        self.replace(len(self.text), len(self.text), new)

    def ids(self) -> bytes:
        return b"".join(ids for _, ids in self.parts)


def encoded(text: Column, path: str, pattern: str, cache_bytes: int | None = None) -> Column:
    """A struct of ``ids, n_tokens, ids_sha256, decoded_sha256``: a text is encoded, and its ids are decoded again.

    A worker keeps ``cache_bytes`` of chunks (by default ``CACHE_BYTES``): fewer cost seconds, more memory.
    """

    @F.pandas_udf("ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string")
    def made(texts: pd.Series) -> pd.DataFrame:
        tokenizer, rows = Tokenizer.of(path, pattern, cache_bytes), []
        texts = texts.fillna("")
        tokenizer.learn_short(texts)
        for text in texts:
            ids = tokenizer.encode(text)
            rows.append((np.frombuffer(ids, "<i4"), len(ids) // 4, hashlib.sha256(ids).hexdigest(), tokenizer.decoded_sha256(ids)))
        return pd.DataFrame(rows, columns=["ids", "n_tokens", "ids_sha256", "decoded_sha256"])

    return made(text)


def encode(text: Column, path: str, pattern: str) -> Column:
    """A text's token ids."""
    return encoded(text, path, pattern)["ids"]


def digests(text: Column, path: str, pattern: str) -> Column:
    """A struct of ``n_tokens, ids_sha256, decoded_sha256``, without the ids."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digested(texts: pd.Series) -> pd.DataFrame:
        tokenizer = Tokenizer.of(path, pattern)
        texts = texts.fillna("")
        tokenizer.learn_short(texts)
        return pd.DataFrame([tokenizer.digests(t) for t in texts], columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digested(text)

"""Alignment of two tokenizers' tokens by coalescing intervals of bytes.

Both encode space + text, so both cut the same bytes. The intervals of all tokens of A and B are sorted by their starts (one lexsort),
the ends are followed by a running maximum, and a group ends where a start reaches it: there, and only there, tokens of both end. Inside
a group overlaps are expanded: every token of A is linked with every token of B.

A text is cut at spaces behind which neither tokenizer looks back (see ``bpe``; no piece of B holds a space behind another character,
which ``Pair`` checks). A worker encodes each distinct chunk once and keeps its ids, up to a bound; a batch's documents are then aligned
as one line of bytes.

Corpus-wide counts: ``align`` stores a row a document with its distinct pairs of ids and how often each is linked. ``pair_counts`` counts
documents a pair. ``with_counts`` brings the counts back: pairs that make up more than a ``HEAVY``-th of all rows number at most ``HEAVY``,
whatever the corpus, and are broadcast; the others shuffle by pair, where none of them is hot any more. A document's sums are taken in
the task that reads it before they shuffle.

Defined cases: a text that is null or empty, or whose bytes as A or B joins them differ from space + text (B may normalise letters), has
no tokens: all numbers are zero and the hash is an empty string. Rows on their own: repeated rows and ids, and null ids, are documents of
their own. An empty table gives no row. A long text goes in slabs; a stretch without a safe space is encoded in one piece. A group of many
tokens of both sides is expanded by distinct ids, some ids of A at a time; rows of the stored table hold ``ROW_PAIRS`` pairs at most.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.llm import chunks
from fleetspark.llm.common import short_batches, stored, whole

#: Pairs of a stored row, and pairs of occurrences that are expanded at once.
ROW_PAIRS, EXPAND = 1 << 16, 1 << 22
#: Pairs held by more than one of so many rows of all pairs are broadcast: there are fewer of them than this.
HEAVY = 1 << 16

_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_TWO_SPACES = re.compile(r"\s\s")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>\Z")


def byte_letters() -> dict[str, int]:
    """The letters that byte-level BPE writes for bytes: printable ones stand for themselves, the others for the letters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def groups_of(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B, counted from 0 in order of place."""
    starts, ends = np.concatenate((starts_a, starts_b)), np.concatenate((ends_a, ends_b))
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order]) if len(order) else ends
    group = np.empty(len(order), np.int64)
    group[order] = np.concatenate(([0], np.cumsum(starts[order][1:] >= reach[:-1]))) if len(order) else []
    return group[: len(starts_a)], group[len(starts_a) :]


def _tallied(*keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys (by the first, then the second ...) and the sums of their times."""
    order = np.lexsort(keys[::-1])
    keys, times = tuple(k[order] for k in keys), times[order]
    new = np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0))) if len(times) else np.array([], bool)
    first = np.flatnonzero(new)
    return *(k[first] for k in keys), np.add.reduceat(times, first) if len(first) else times


def linked_pairs(owner_a: np.ndarray, ids_a: np.ndarray, group_a: np.ndarray, ids_b: np.ndarray, group_b: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each owner of groups the distinct ``a * width + b`` of tokens that share a group, and how many pairs of occurrences each has.

    Up to ``EXPAND`` pairs are expanded at once. More are expanded by distinct ids: equal ids of a group are one entry with a number of
    times, and entries of A in order of owner and id go in slices that end where these change, so a slice has about ``EXPAND`` pairs, or
    those of one id: not more than there are entries of B.
    """
    ones = np.ones(len(ids_a), np.int64)
    low = np.searchsorted(group_b, group_a)
    partners = np.searchsorted(group_b, group_a, "right") - low
    if partners.sum() <= EXPAND:
        owner, a, n, b, m = owner_a, ids_a, ones, ids_b, np.ones(len(ids_b), np.int64)
        edges = np.array([0, len(a)])
    else:
        owner, a, group_a, n = _tallied(owner_a, ids_a, group_a, times=ones)
        group_b, b, m = _tallied(group_b, ids_b, times=np.ones(len(ids_b), np.int64))
        low = np.searchsorted(group_b, group_a)
        partners = np.searchsorted(group_b, group_a, "right") - low
        edges = np.append(np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (owner[1:] != owner[:-1])))), len(a))
    made = chunks.before(partners)[edges]
    found, at = [(np.array([], np.int64),) * 3], 0
    while at < len(edges) - 1:
        until = max(at + 1, int(np.searchsorted(made, made[at] + EXPAND, "right")) - 1)
        entries = slice(edges[at], edges[until])
        right = chunks.ragged(low[entries], partners[entries])
        spread = lambda x: np.repeat(x[entries], partners[entries])  # noqa: B023, E731
        found.append(_tallied(spread(owner), spread(a * width) + b[right], times=spread(n) * m[right]))
        at = until
    return tuple(np.concatenate(x) for x in zip(*found))


class Pair:
    """Two tokenizers, and the ids of chunks by both."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        of_a = {i: bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode() for token, i in self.a.get_vocab().items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece holds a space behind another character, so texts can't be cut at spaces")
        of_b = {i: bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.match(p)) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)}
        self.bytes_a, self.bytes_b, self.width, self.width_a = of_a, of_b, len(pieces), max(of_a) + 1
        self.lengths_a, self.lengths_b = (np.array([len(t.get(i, b"")) for i in range(max(t) + 1)], np.int64) for t in (of_a, of_b))
        self.space = self.b.piece_to_id("▁")
        self.written = [mark + b"%d" % i for mark, n in ((b",", self.width_a), (b";", self.width_a), (b",", self.width), (b"|", self.width)) for i in range(n)]
        said = json.loads(self.a.to_str())
        cut = said["pre_tokenizer"] or {}
        #: Whether a space and letters are one piece, whose bytes the model encodes as they are.
        self.letters_alone = said["normalizer"] is None and said["model"]["type"] == "BPE" and (cut.get("type"), cut.get("use_regex"), cut.get("add_prefix_space")) == ("ByteLevel", True, False)
        self.spelled = {b_: c for c, b_ in letters.items()}
        self.ids_a: dict[str, bytes] = {}
        self.ids_b: dict[str, bytes] = {}
        self.broken: set[str] = set()
        self.held = 0

    @staticmethod
    @lru_cache(maxsize=4)
    def of(path_a: str, path_b: str) -> Pair:
        return Pair(path_a, path_b)

    def encoded_a(self, texts: list[str]) -> list[list[int]]:
        """A's ids of stretches, each with a space before it."""
        alone = [self.letters_alone and t.isalpha() for t in texts]
        others = iter(self.a.encode_batch([" " + t for t, one in zip(texts, alone) if not one], add_special_tokens=False))
        spelled = lambda t: (" " + t).encode().decode("latin-1").translate(self.spelled)
        return [[x.id for x in self.a.model.tokenize(spelled(t))] if one else next(others).ids for t, one in zip(texts, alone)]

    def learn(self, stretches: set[str]) -> None:
        """Encode the new ones of chunks; when too much is kept, all goes first. Those whose bytes either tokenizer changes are ``broken``."""
        if self.held > chunks.KEPT_BYTES:
            self.ids_a.clear()
            self.ids_b.clear()
            self.broken.clear()
            self.held = 0
        fresh = list(stretches.difference(self.ids_a))
        bytes_a, bytes_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        for t, a, b in zip(fresh, self.encoded_a(fresh), self.b.encode(fresh, num_threads=1) if fresh else ()):
            b = b if t else [self.space]
            if not b"".join(map(bytes_a, a)) == b" " + t.encode() == b"".join(map(bytes_b, b)):
                self.broken.add(t)
            self.ids_a[t], self.ids_b[t] = array("i", a).tobytes(), array("i", b).tobytes()
            self.held += 350 + len(t) + 4 * (len(a) + len(b))

    def cut(self, stretch: str, later: bool) -> list[str]:
        """A stretch of a text as chunks that each have a space before them; one that isn't the first begins with its space."""
        spaced = stretch if later else " " + stretch
        if not _TWO_SPACES.search(spaced):
            return spaced[1:].split(" ")
        first, *others = _SAFE_SPACE.split(spaced)  # the space in front has nothing behind it, so it stays with the first
        return [first[1:], *others]

    def documents(self, texts: list[str]) -> list[Aligned]:
        """Alignments of texts, slab by slab."""
        good, counts, hashes = np.ones(len(texts), bool), np.zeros((len(texts), 4), np.int64), [hashlib.sha256() for _ in texts]
        pairs: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in texts]
        begun: set[int] = set()
        for group in chunks.slabs(texts, lambda text, at: m.start() if (m := _SAFE_SPACE.search(text, at)) else len(text)):
            cut = [self.cut(stretch, place in begun) for place, stretch in group]
            self.learn(set().union(*cut))
            for (place, _), words in zip(group, cut):
                good[place] &= self.broken.isdisjoint(words)
            kept = [(place, words) for (place, _), words in zip(group, cut) if good[place]]
            a, b = ([b"".join(map(ids.__getitem__, words)) for _, words in kept] for ids in (self.ids_a, self.ids_b))
            for (place, _), *stretch in zip(kept, *self.aligned(a, b)):
                n, written, keys, times = stretch
                hashes[place].update(written if place in begun else written[1:])
                counts[place] += n
                pairs[place].append((keys, times))
            begun.update(place for place, _ in group)
        found = []
        for place in range(len(texts)):
            if not good[place] or not pairs[place]:
                found.append(Aligned(np.zeros(4, np.int64), "", np.array([], np.int64), np.array([], np.int64)))
                continue
            keys, times = pairs[place][0] if len(pairs[place]) == 1 else _tallied(np.concatenate([k for k, _ in pairs[place]]), times=np.concatenate([t for _, t in pairs[place]]))
            found.append(Aligned(counts[place], hashes[place].hexdigest(), keys, times))
        return found

    def aligned(self, a: list[bytes], b: list[bytes]) -> tuple[np.ndarray, list[bytes], list[np.ndarray], list[np.ndarray]]:
        """Of stretches, given as ids of both: tokens of A, tokens of B, groups and links; the groups as text, each with a mark before it; the pairs of
        ids and how often each is linked. Stretches have as many bytes by A as by B, so one line of places holds all of them."""
        ids_a, ids_b = (np.frombuffer(b"".join(x), "<i4").astype(np.int64) for x in (a, b))
        edge_a, edge_b = (chunks.before(np.array([len(x) // 4 for x in ids])) for ids in (a, b))
        length_a, length_b = self.lengths_a[ids_a], self.lengths_b[ids_b]
        end_a, end_b = np.cumsum(length_a), np.cumsum(length_b)
        group_a, group_b = groups_of(end_a - length_a, end_a, end_b - length_b, end_b)
        n_a, n_b = np.bincount(group_a), np.bincount(group_b)
        at_a, at_b, links = chunks.before(n_a), chunks.before(n_b), chunks.before(n_a * n_b)
        edge_g = np.searchsorted(group_a, np.arange(len(n_a) + 1))  # where a group's tokens of A begin
        edge_g = np.searchsorted(edge_g, edge_a)  # how many groups are before a stretch
        counts = np.stack((np.diff(edge_a), np.diff(edge_b), np.diff(edge_g), np.diff(links[edge_g])), 1)
        code = np.empty(len(ids_a) + len(ids_b), np.int64)
        first_a, first_b = (np.concatenate(([True], g[1:] != g[:-1]))[: len(g)] for g in (group_a, group_b))
        code[np.arange(len(ids_a)) + at_b[group_a]] = ids_a + first_a * self.width_a
        code[np.arange(len(ids_b)) + at_a[group_b + 1]] = ids_b + 2 * self.width_a + first_b * self.width
        word, edges = self.written.__getitem__, edge_a + edge_b
        written = [b"".join(map(word, code[low:high].tolist())) for low, high in zip(edges[:-1], edges[1:])]
        owner, keys, times = linked_pairs(np.repeat(np.arange(len(a)), np.diff(edge_a)), ids_a, group_a, ids_b, group_b, self.width)
        own = np.searchsorted(owner, np.arange(len(a) + 1))
        return counts, written, np.split(keys, own[1:-1]), np.split(times, own[1:-1])


@dataclass(slots=True)
class Aligned:
    """What a document gives."""

    counts: np.ndarray  # tokens of A, tokens of B, groups, links
    groups_sha256: str
    keys: np.ndarray
    times: np.ndarray


_ROWS = "doc_id {}, row long, first boolean, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, width int, pairs array<long>, links array<long>"


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A stored table of ``doc_id, row, first, n_a, n_b, n_groups, n_links, groups_sha256, width, pairs, links``.

    ``row`` numbers the documents, ``pairs`` are distinct ``a * width + b``, ``links`` how often each is linked. A document of more than
    ``ROW_PAIRS`` pairs has more rows, of which one is the ``first``.
    """
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    schema = _ROWS.format(rows.schema["doc_id"].dataType.simpleString())

    def made(batches):
        pair = Pair.of(path_a, path_b)
        for batch in batches:
            ids, numbers = batch["doc_id"].take, batch["row"].to_numpy()
            found = pair.documents(batch["text"].to_pylist())
            parts = [(i, at) for i, x in enumerate(found) for at in range(0, max(1, len(x.keys)), ROW_PAIRS)]
            lists = [(found[i].keys[at : at + ROW_PAIRS], found[i].times[at : at + ROW_PAIRS]) for i, at in parts]
            edges = pa.array(chunks.before(np.array([len(k) for k, _ in lists], np.int64)), pa.int32())
            place = np.array([i for i, _ in parts], np.int64)
            counts = np.array([x.counts for x in found]).reshape(-1, 4)[place]
            columns = [ids(pa.array(place)), pa.array(numbers[place]), pa.array([at == 0 for _, at in parts]), *(pa.array(c) for c in counts.T), pa.array([found[i].groups_sha256 for i in place])]
            columns += [pa.array(np.full(len(parts), pair.width, np.int32))]
            columns += [pa.ListArray.from_arrays(edges, pa.array(np.concatenate([x[k] for x in lists]) if lists else [], pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "first", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "width", "pairs", "links"])

    return stored(rows.mapInArrow(made, schema), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """A stored table of ``pair, held, best``: documents that hold a pair linked, and whether no pair of its A id is held by more."""
    counts = stored(aligned.select("width", F.explode("pairs").alias("pair")).groupBy("pair", "width").agg(F.count("*").alias("held")), "aligned-counts")
    id_a = F.expr("pair div width")
    most = counts.groupBy(id_a.alias("a")).agg(F.max("held").alias("most"))
    # a row an id of A's vocabulary, so its size is bounded by that
    return stored(counts.join(F.broadcast(most), id_a == F.col("a")).select("pair", "held", (F.col("held") == F.col("most")).alias("best")), "aligned-best")


def with_counts(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    every = counts.agg(F.sum("held")).first()[0] or 0
    bound = every // HEAVY
    heavy = F.broadcast(counts.where(F.col("held") > bound))  # fewer than HEAVY rows
    rows = aligned.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.links").alias("links"))
    sums = [F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("held")).alias("count_sum")]
    often = rows.join(heavy, "pair").groupBy("row").agg(*sums)
    rarely = rows.join(heavy.select("pair"), "pair", "left_anti").join(counts.where(F.col("held") <= bound), "pair").groupBy("row").agg(*sums)
    whole_ = often.unionByName(rarely).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return aligned.where("first").join(whole_, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")

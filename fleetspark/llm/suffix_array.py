"""Substring dedup of bytes by bucket-pointer refinement of a sparse suffix array.

Suffixes at the anchors of 400-byte windows (``repeats``) are dealt out in groups. A task puts the suffixes of its groups into
buckets by their first 25 bytes; a suffix's bucket pointer is the place in the array where its bucket begins. Bucket by bucket,
suffixes are then sorted by the pointers of the suffixes that start as far behind them as is known to be equal, and their own
pointers are updated at once, so that buckets refined later in the same pass, and the next pass, which looks twice as far,
already use them. Buckets of one suffix are done. Once 400 bytes are sorted, equal windows stand side by side; neighbours
are compared byte by byte. Every place of a window that has an equal one is removed, in whatever document.

Defined cases: null is an empty text; texts under ``length`` bytes lose nothing; rows with equal texts of ``length`` bytes or more lose
all, also if they share an id; a row with a null id loses nothing. Different texts must not share an id; ids are whole numbers,
and one that can't be cast to a number is an error. What is left of a text may end inside a character. Any length of text is taken in slabs.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.repeats import Bytes, gram_hashes, removed, spans_of, windows_of

LENGTH, GRAM = 400, 25
#: Suffixes whose buckets are refined together; those after them see the new pointers.
TOGETHER = 1 << 17


class SuffixArray:
    """Suffixes of some byte strings in an order in which equal first ``length`` bytes are side by side.

    The order is that of hashes of ``gram`` bytes, block after block, and ``length`` is a multiple of ``gram``. A string's end
    is a symbol of its own.
    """

    def __init__(self, contents: list[bytes], length: int, gram: int):
        if length % gram:
            raise ValueError("the length is to be a multiple of the gram's")
        self.length, self.gram = length, gram
        self.sizes = np.array([len(c) for c in contents], np.int64)
        self.data = np.frombuffer(b"".join(contents), np.uint8)
        total = len(self.data)
        ends = np.cumsum(self.sizes)
        self.starts = ends - self.sizes
        self.owner = np.repeat(np.arange(len(contents), dtype=np.int32), self.sizes)
        self.left = np.repeat(ends, self.sizes) - np.arange(total)  # symbols up to the string's end
        hashes = gram_hashes(Bytes(self.data.tobytes()).symbols(0, total), gram) if total >= gram else np.zeros(0, np.uint64)
        whole = np.flatnonzero(self.left >= gram)
        _, rank, counts = np.unique(hashes[whole], return_inverse=True, return_counts=True)
        # tails shorter than a gram are alone, behind all others
        self.pointers = np.arange(total) + len(whole)
        self.pointers[whole] = (np.cumsum(counts) - counts)[rank]
        self.first = self.pointers.copy()
        self.order = whole[np.argsort(self.pointers[whole], kind="stable")]
        self.refine()

    def refine(self) -> None:
        """Passes over the buckets of several suffixes, of which ``depth`` bytes are sorted before each."""
        depth = self.gram
        while depth < self.length:
            heads = np.append(np.flatnonzero(np.diff(self.pointers[self.order], prepend=-1)), len(self.order))
            sizes = np.diff(heads)
            several = np.flatnonzero(sizes > 1)
            if not len(several):
                return
            sums = np.cumsum(sizes[several])
            cuts = np.unique(np.searchsorted(sums, np.arange(TOGETHER, sums[-1], TOGETHER)) + 1)
            for buckets in np.split(several, cuts):
                if len(buckets):
                    self.refine_buckets(heads[buckets], sizes[buckets], depth)
            depth *= 2

    def refine_buckets(self, heads: np.ndarray, sizes: np.ndarray, depth: int) -> None:
        """Sort some buckets by the pointers ``depth`` bytes on, and point their suffixes at the buckets that come of it."""
        slots = np.repeat(heads - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        places = self.order[slots]
        inside = self.left[places] > depth
        strings, base = len(self.sizes), np.repeat(heads, sizes)
        keys = np.where(inside, self.pointers[np.where(inside, places + depth, 0)] + strings, self.owner[places])
        both = base << 32 | keys
        sorted_ = np.argsort(both)
        places, both = places[sorted_], both[sorted_]
        begins = np.append(True, both[1:] != both[:-1])
        self.order[slots] = places
        self.pointers[places] = np.maximum.accumulate(np.where(begins, slots, 0))

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, content and place of each window; windows of one class have equal bytes."""
        owner, place = windows_of(self.sizes, self.length)
        found = self.order[self.left[self.order] >= self.length]
        same = np.append(False, self.equal(found[:-1], found[1:])) if len(found) else np.zeros(0, bool)
        classes = np.empty(len(self.data), np.int64)
        classes[found] = np.cumsum(~same) - 1
        return classes[self.starts[owner] + place], owner, place

    def equal(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the ``length`` bytes from two places on are equal, pair by pair."""
        width = min(8, self.length)
        strides = np.lib.stride_tricks.sliding_window_view(self.data, width)
        words = np.zeros((len(strides), 8), np.uint8)
        words[:, :width] = strides
        words = words.view(np.uint64).ravel()
        alive = np.flatnonzero(self.first[left] == self.first[right])
        for at in [*range(0, self.length - width, width), self.length - width]:
            alive = alive[words[left[alive] + at] == words[right[alive] + at]]
        out = np.zeros(len(left), bool)
        out[alive] = True
        return out


def array_index(contents: list[bytes], groups: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One array for the strings of all groups."""
    return SuffixArray(contents, length, gram).windows()


def _row(text: Bytes, runs: list[tuple[int, int]]) -> tuple:
    kept, at = [], 0
    for start, stop in [*runs, (len(text), len(text))]:
        kept.append(text.data[at:start])
        at = stop
    clean = b"".join(kept)
    return len(text), len(text) - len(clean), len(runs), hashlib.sha256(clean).hexdigest(), clean


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``: texts without the bytes that also stand elsewhere."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spans = spans_of(rows, Bytes, lambda contents, groups, n: array_index(contents, groups, n, gram), length, gram, first_stays=False)
    return removed(rows, spans, Bytes, _row, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")

"""Substring dedup of words with prefix-partitioned suffix trees.

Suffixes that start in the 50-word windows of an anchor (``repeats``) are partitioned by a prefix of variable length at the anchor,
each group small enough for memory: eight words, or more where eight are too common. A task makes the suffix trees of its groups
as lists of leaves in order and of the depths at which neighbours branch, reading a range of words of every suffix that is
not yet alone at a time, the longer the fewer there are. Then the tree's internal nodes are known: each is a stretch of leaves
whose branches lie no less deep. A node of ``length`` words or more is a repeat, as long as its depth and maximal to the right;
the least id below it keeps its words, the others lose theirs.

Defined cases: null is a text without words, and keeps none; texts under ``length`` words lose nothing; rows that repeat
id and text count as one; a row with a null id loses nothing and takes nothing from others. Different texts must not share
an id; ids are whole numbers, and one that can't be cast to a number is an error. Any length of text is taken in slabs.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.repeats import Words, removed, spans_of, windows_of

LENGTH, PREFIX = 50, 8
#: Words read at once for all suffixes that are not alone, and of one suffix at most.
READ_WORDS, READ_MOST = 1 << 21, 32


class SuffixTrees:
    """Suffix trees, one a group, over the suffixes of some texts that have ``length`` words or more.

    ``leaves`` are suffixes (numbers in the order of texts and places) in the order of the trees, and ``branch[i]`` is the depth at
    which leaf i parts from leaf i - 1, or -1 where a tree begins. A text's end is a word of its own.
    """

    def __init__(self, contents: list[bytes], groups: np.ndarray, length: int):
        words = [c.split() for c in contents]
        sizes = np.array([len(w) for w in words], np.int64)
        self.length = length
        self.owner, self.place = windows_of(sizes, length)
        numbers: dict[bytes, int] = {}
        ends = np.cumsum(sizes + 1) - 1
        symbols = np.empty(int((sizes + 1).sum()), np.int32)
        for own, end, size in zip(words, ends, sizes):
            symbols[end - size : end] = [numbers.setdefault(w, len(numbers)) for w in own]
        symbols[ends] = len(numbers) + np.arange(len(words))
        self.leaves = np.argsort(groups[self.owner], kind="stable")
        self.branch = np.zeros(len(self.leaves), np.int64)
        tree = groups[self.owner][self.leaves]
        self.branch[np.append(True, tree[1:] != tree[:-1])[: len(tree)]] = -1
        self.grow(symbols, (ends - sizes)[self.owner] + self.place, ends[self.owner])

    def grow(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Order the leaves and find where they branch. A leaf is alone once it parts from both neighbours."""
        parted = self.branch < 0
        depth = 0
        while True:
            alone = parted & np.append(parted[1:], True)
            slots = np.flatnonzero(~alone)
            if not len(slots):
                return
            read = max(2, min(READ_MOST, READ_WORDS // len(slots)) // 2 * 2)
            leaves, branch = self.leaves[slots], np.cumsum(parted[slots])
            seen = symbols[np.minimum((starts[leaves] + depth)[:, None] + np.arange(read), ends[leaves][:, None])]
            pairs = seen[:, ::2].astype(np.int64) << 32 | seen[:, 1::2]
            order = np.lexsort((*pairs.T[::-1], branch))
            self.leaves[slots], seen = leaves[order], seen[order]
            differ = seen[1:] != seen[:-1]
            fresh = differ.any(axis=1) & (branch[1:] == branch[:-1])  # sorting keeps branches together, so theirs are as before
            at = slots[1:][fresh]
            self.branch[at] = depth + differ[fresh].argmax(axis=1)
            parted[at] = True
            depth += read

    def repeats(self) -> np.ndarray:
        """For each suffix, the number of the highest node of ``length`` words or more that it is below; alone if it is below none."""
        found = np.empty(len(self.leaves), np.int64)
        found[self.leaves] = np.cumsum(self.branch < self.length) - 1
        return found

    def nodes(self, least: int = 0) -> list[tuple[int, int, int]]:
        """(depth, first leaf, last leaf) of each internal node that is ``least`` words deep or more, children before parents."""
        out: list[tuple[int, int, int]] = []
        open_: list[tuple[int, int]] = []
        deep = self.branch >= max(least, 0)
        for i in np.flatnonzero(deep | np.append(deep[:-1] & ~deep[1:], False) | np.append(False, deep[:-1])):
            depth, left = int(self.branch[i]), int(i) - 1
            while open_ and open_[-1][0] > depth:
                out.append((open_[-1][0], open_[-1][1], int(i) - 1))
                left = open_.pop()[1]
            if depth >= max(least, 0) and (not open_ or open_[-1][0] < depth):
                open_.append((depth, left))
        while open_:
            out.append((open_[-1][0], open_.pop()[1], len(self.leaves) - 1))
        return out


def tree_index(contents: list[bytes], groups: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    trees = SuffixTrees(contents, groups, length)
    return trees.repeats(), trees.owner, trees.place


def _row(text: Words, runs: list[tuple[int, int]]) -> tuple:
    kept, at = [], 0
    for start, stop in [*runs, (len(text), len(text))]:
        kept += text.words[at:start]
        at = stop
    clean = b" ".join(kept).decode()
    return len(text), len(text) - len(kept), hashlib.sha256(clean.encode()).hexdigest(), clean


def without_repeats(docs: DataFrame, length: int = LENGTH, prefix: int = PREFIX, id_col: str | Column = "doc_id", text_col: str | Column = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept_text``: texts without the words that an earlier document has."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spans = spans_of(rows, Words, tree_index, length, prefix, first_stays=True)
    return removed(rows, spans, Words, _row, "n_words long, n_removed long, kept_sha256 string, kept_text string")

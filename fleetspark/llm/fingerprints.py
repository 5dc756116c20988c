"""Document fingerprints by locally consistent parsing.

A text's bytes are parsed level by level into phrases. On each level runs of one name become a phrase; then deterministic
coin tossing gives each name a small label that depends on it and a few names to its left, neighbours never share a label,
and phrases end before labels that are local maxima. A phrase's name is a hash of its names, so names need no dictionary and equal substrings have
equal interior phrases wherever they stand. Each level is at most half as long as the one below.

The fingerprint is a sketch of the set of phrase names of level ``LEVEL`` (about fifteen bytes each): ``BINS`` bins of 32 bits,
each the least hash of the names that fall into it, in hexadecimal, ``........`` for an empty bin. The likeness of two
fingerprints is the share of equal bins among the bins that either fills, an estimate of the sets' Jaccard similarity.

Defined cases: a null text is empty; the fingerprint of an empty text has no filled bin, and two such are alike (1), else
0; equal texts have equal fingerprints. For ``with_edits``, rows are in order of id, then text, null ids first; the next of
the last row is the first; a single row is its own next; an empty table gives an empty result. Memory is one batch of texts; rows are
dealt by ranges of ids, and beside its own rows a range gets the first row of the next range.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import short_batches, whole

LEVEL, BINS = 3, 64
#: One more than a bin can hold. Even in a text of 2 GB two unrelated bins agree with a chance of 0.0003 at most.
EMPTY = 1 << 32
RANGE_ROWS, MAX_RANGES = 4096, 200_000
_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
#: Place of the lowest set bit of a byte.
_LOWEST = np.array([8] + [(i & -i).bit_length() - 1 for i in range(1, 256)], np.uint8)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _joined(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A name for each phrase [starts[i], starts[i + 1]): a hash of its names and their places in it."""
    lengths = np.diff(np.append(starts, len(names)))
    place = np.arange(len(names)) - np.repeat(starts, lengths)
    return _mixed(np.add.reduceat(_mixed(names + (place + 1).astype(np.uint64) * _STEP), starts) + lengths.astype(np.uint64))


def _tossed(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6 that differ between neighbours of one text. ``first`` marks each text's first name."""
    differ = names[1:] ^ names[:-1]
    if names.dtype == np.uint64:  # the lowest differing bit, byte by byte
        low = differ & (~differ + np.uint64(1))
        place = np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.uint8)
        bit = ((names[1:] >> place.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
    else:
        place = _LOWEST[differ]
        bit = names[1:] >> np.minimum(place, 7) & 1
    labels = np.empty(len(names), np.uint8)
    labels[1:] = 2 * place + bit
    labels[0] = 0
    labels[first] = (names[first] & names.dtype.type(1)).astype(np.uint8)
    for _ in range(3):
        place = _LOWEST[labels[1:] ^ labels[:-1]]
        shorter = np.empty_like(labels)
        shorter[1:] = 2 * place + (labels[1:] >> np.minimum(place, 7) & 1)
        shorter[0] = 0
        shorter[first] = labels[first] & 1
        labels = shorter
    return labels


def parse(texts: list[bytes], level: int = LEVEL) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of a level for all texts on end, and the text that each belongs to. A short text may have one name."""
    sizes = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    owner = np.repeat(np.arange(len(texts)), sizes)
    names = raw
    for depth in range(level):
        if not len(names):
            break
        new_text = np.empty(len(names), bool)
        new_text[0], new_text[1:] = True, owner[1:] != owner[:-1]
        run = new_text.copy()
        run[1:] |= names[1:] != names[:-1]
        heads = np.flatnonzero(run)
        lengths = np.diff(np.append(heads, len(names)))
        names, owner = names[heads], owner[heads]
        first = np.flatnonzero(new_text[heads])
        labels = _tossed(names, first)
        wide = names.astype(np.uint64)
        wide = np.where(lengths > 1, _mixed(wide + lengths.astype(np.uint64) * _STEP), wide)
        cut = np.zeros(len(names), bool)
        if len(names) > 2:
            cut[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
        starts_text = np.zeros(len(names) + 1, bool)
        starts_text[first] = starts_text[-1] = True
        # neither a text's first nor its second nor its last name starts a phrase of its own
        cut &= ~starts_text[1:]
        cut[1:] &= ~starts_text[:-2]
        cut[first] = True
        starts = np.flatnonzero(cut)
        names, owner = _joined(wide, starts), owner[starts]
    return names, owner


def sketch(texts: list[str], level: int = LEVEL) -> np.ndarray:
    """One row of bins a text; ``EMPTY`` marks an empty bin."""
    names, owner = parse([t.encode() for t in texts], level)
    found = np.full(len(texts) * BINS, EMPTY, np.int64)
    if len(names):
        spread = _mixed(names.astype(np.uint64) + _STEP)
        bins = owner * BINS + (spread >> np.uint64(58)).astype(np.int64) % BINS
        np.minimum.at(found, bins, (spread & np.uint64(EMPTY - 1)).astype(np.int64))
    return found.reshape(len(texts), BINS)


def written(bins: np.ndarray) -> list[str]:
    return ["".join("........" if b == EMPTY else f"{b:08x}" for b in row) for row in bins.tolist()]


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row: equal bins among those that either fills."""
    filled = (left < EMPTY) | (right < EMPTY)
    equal = ((left == right) & filled).sum(axis=1)
    total = filled.sum(axis=1)
    return np.where(total > 0, equal / np.maximum(total, 1), 1.0)


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column, as a string."""

    @F.pandas_udf("string")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series(written(sketch([t or "" for t in texts])))

    return made(whole(text))


EDITS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _ranged(docs: DataFrame, range_rows: int) -> tuple[DataFrame, int]:
    """``doc_id, text, range, ahead``: rows by range of ids, and the first row of a range once more, ahead, in the range before.

    Ranges hold about ``range_rows`` rows, more only beyond ``MAX_RANGES`` of them; what the driver sees is a number or two a range.
    """
    ids = docs.agg(F.count("*").alias("n"), F.count("doc_id").alias("ids")).first()
    ranges = min(MAX_RANGES, max(1, -(-ids["n"] // range_rows)))
    marks = np.unique(np.array(docs.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.1 / ranges) if ids["ids"] and ranges > 1 else [], np.int64))

    @F.pandas_udf("int")
    def at(values: pd.Series) -> pd.Series:  # null ids come first
        return pd.Series(np.where(values.isna(), 0, np.searchsorted(marks, values.fillna(0).to_numpy(np.int64), side="right"))).astype("int32")

    used = docs.select("doc_id").withColumn("range", at("doc_id")).groupBy("range")
    heads = sorted(map(tuple, used.agg(F.max(F.col("doc_id").isNull()), F.min("doc_id")).collect()))
    placed = docs.select("doc_id", whole().alias("text")).withColumn("range", at("doc_id"))
    if not heads:
        return placed.withColumn("ahead", F.lit(0)), 1
    # ranges that hold rows are numbered anew, without gaps; the first row of the first goes behind the last
    known = [(r, i, (i - 1) % len(heads), 1 if i else 2, None if none else head) for i, (r, none, head) in enumerate(heads)]
    known = docs.sparkSession.createDataFrame(known, "range int, own int, before int, turn int, head long")
    own, before = F.struct(F.col("own").alias("range"), F.lit(0).alias("ahead")), F.struct(F.col("before").alias("range"), F.col("turn").alias("ahead"))
    is_head = F.col("doc_id").eqNullSafe(F.col("head"))
    spots = F.explode(F.when(is_head, F.array(own, before)).otherwise(F.array(own)))
    return placed.join(F.broadcast(known), "range").select("doc_id", "text", spots.alias("c")).select("doc_id", "text", "c.*"), len(heads)  # a row a range


def with_edits(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Columns of ``EDITS``: each text beside its edit, whose last quarter is the next document's beginning."""
    short_batches(docs.sparkSession, 256)
    rows, ranges = _ranged(docs, range_rows)

    def compared(batches):
        held: tuple | None = None  # the last row so far, which waits for its next
        range_ = None
        for batch in batches:
            rows_ = list(zip(batch.column("range").to_pylist(), batch.column("ahead").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()))
            pairs = []
            for r, ahead, id_, text in rows_:
                if held is not None and range_ == r:
                    pairs.append((held[0], held[1], text))
                    held = None
                held, range_ = (None if ahead else (id_, text)), r
            if pairs:
                yield _edited(pairs)

    spread = rows.repartitionById(ranges, F.col("range")).sortWithinPartitions(F.col("range"), "ahead", F.col("doc_id").asc_nulls_first(), "text")
    return spread.select("range", "ahead", "doc_id", "text").mapInArrow(compared, EDITS)


def _edited(pairs: list[tuple]) -> pa.RecordBatch:
    texts, edits = [text for _, text, _ in pairs], []
    for _, text, following in pairs:
        quarter = len(text) // 4
        edits.append(text[: len(text) - quarter] + following[:quarter])
    own, edited = sketch(texts), sketch(edits)
    following = np.roll(own, -1, axis=0)  # the next text is the next row's, but behind the last row of a range
    if other := [i for i in range(len(pairs)) if i + 1 == len(pairs) or texts[i + 1] is not pairs[i][2]]:
        following[other] = sketch([pairs[i][2] for i in other])
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array([p[0] for p in pairs], pa.int64()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            "edited_sha256": [hashlib.sha256(e.encode()).hexdigest() for e in edits],
            "fingerprint": written(own),
            "edited_fingerprint": written(edited),
            "near_edited": likeness(own, edited),
            "near_next": likeness(own, following),
        }
    )

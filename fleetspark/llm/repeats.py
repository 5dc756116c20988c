"""Strings of a given length that occur more than once, found over sparse suffixes: what both substring dedups share.

A window is ``length`` symbols (bytes or words) of one text. Each window has an anchor: the place in it whose ``gram``
symbols have the least hash, the last one of ties. It depends on the window alone, so equal windows have equal anchors at
equal offsets, and windows with one anchor are consecutive. So instead of every suffix only those at anchors are dealt out:

1. ``keyed``: per text its length, a hash, and the hashes of its anchors' grams. Equal texts are one class, and its least
   id alone goes on. Gram hashes that occur once are dropped: no window with such an anchor repeats.
2. ``records``: for each anchor left, the windows that it has, as one string (its hull) with the places where it starts.
   Equal hulls of one batch are one record. The prefix by which records are grouped has a variable length: the gram where
   its group fits into memory, and where a gram is hotter, the string common to a run of fewer windows, down to the window itself
   (``TIERS``).
3. ``resolved``: a task sorts its groups by hull. Members of equal hulls are settled as they pass; of distinct hulls only
   one each is held, and the caller's index (suffix trees or a suffix array) tells which of their windows are equal.

Texts are joined with their spots, and later with their spans, by id: rows of either grow with a text, so none is broadcast.
Hashes of grams choose candidates and groups; hulls and windows are compared by their content. Only whole texts are told apart
by 128-bit hashes and their lengths.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import short_batches, stored
from fleetspark.llm.ngram_join import word_hashes

#: Windows of one text that are looked at together; texts may be longer.
SLAB = 1 << 20
#: Members of a gram up to which all its windows go together (0), or in runs of the window's length divided by a number.
TIERS = ((2000, 0), (16_000, 8), (64_000, 64), (1 << 62, 1 << 30))
#: Bytes of distinct hulls that a task resolves together.
GROUP_BYTES = 2 << 20

#: From contents, the group of each, and a length to the class of each window, the content that it is in and its place there;
#: windows are in the order of contents and places, and equal windows of a group share a class.
Index = Callable[[list[bytes], np.ndarray, int], tuple[np.ndarray, np.ndarray, np.ndarray]]

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOW = np.uint64((1 << 24) - 1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(name: str, base: int, count: int) -> np.ndarray:
    known = _powers[name]
    if len(known) < count:
        more = np.full(max(count, 2 * len(known)), np.uint64(base))
        more[0] = np.uint64(1)
        known = _powers[name] = np.cumprod(more)
    return known[:count]


class Bytes:
    """Texts as their UTF-8 bytes."""

    _table = np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64, endpoint=False)

    def __init__(self, text: str | bytes | None):
        self.data = text if isinstance(text, bytes) else (text or "").encode()

    def __len__(self) -> int:
        return len(self.data)

    def symbols(self, start: int, end: int) -> np.ndarray:
        return self._table[np.frombuffer(self.data, np.uint8, max(0, min(end, len(self.data)) - start), start)]

    def piece(self, start: int, end: int) -> bytes:
        return self.data[start:end]

    whole = property(lambda self: self.data)


class Words:
    """Texts as their words."""

    def __init__(self, text: str | bytes | None):
        self.words = (text if isinstance(text, bytes) else (text or "").encode()).split()

    def __len__(self) -> int:
        return len(self.words)

    def symbols(self, start: int, end: int) -> np.ndarray:
        return word_hashes(self.words[start:end])

    def piece(self, start: int, end: int) -> bytes:
        return b" ".join(self.words[start:end])

    whole = property(lambda self: b" ".join(self.words))


def gram_hashes(symbols: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` symbols from each place on."""
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * _power("up", _BASE, len(symbols)), out=sums[1:])
    found = (sums[gram:] - sums[:-gram]) * _power("down", _INVERSE, len(symbols) - gram + 1)
    found = (found ^ (found >> np.uint64(30))) * _M1
    found = (found ^ (found >> np.uint64(27))) * _M2
    return found ^ (found >> np.uint64(31))


def anchors(text: Bytes | Words, length: int, gram: int) -> list[tuple[int, int, int, int]]:
    """(gram hash, place, first window, last window) of each anchor, in order of windows."""
    found = []
    for at in range(0, len(text) - length + 1, SLAB):
        symbols = text.symbols(at, at + SLAB + length - 1)
        count = len(symbols) - gram + 1
        grams = gram_hashes(symbols, gram)
        # the least of each window's grams, by minima from block edges; the low bits hold the place, later ones first
        width = length - gram + 1
        keys = np.full(-(-count // width) * width, np.uint64((1 << 64) - 1))
        keys[:count] = (grams & ~_LOW) | (_LOW - np.arange(count, dtype=np.uint64))
        blocks = keys.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = len(symbols) - length + 1
        least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])
        places = (_LOW - (least & _LOW)).astype(np.int64)
        first = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
        last = np.append(first[1:], windows) - 1
        own = places[first]
        found += zip(grams[own].view(np.int64).tolist(), (own + at).tolist(), (first + at).tolist(), (last + at).tolist())
    return found


def keyed(docs: DataFrame, alphabet: type, length: int, gram: int) -> DataFrame:
    """``doc_id, n, h1, h2, grams`` of each row; a gram is listed once, with the places in the list of anchors that have it."""
    spotted = pa.list_(pa.struct([("gram", pa.int64()), ("spots", pa.list_(pa.int32()))]))

    def made(batches):
        for batch in batches:
            texts = [alphabet(t) for t in batch.column("text").to_pylist()]
            digests = np.frombuffer(b"".join(xxhash.xxh128_digest(t.whole) for t in texts), np.int64).reshape(-1, 2)
            lists = []
            for t in texts:
                own: dict[int, list[int]] = {}
                for spot, anchor in enumerate(anchors(t, length, gram)):
                    own.setdefault(anchor[0], []).append(spot)
                lists.append([{"gram": g, "spots": spots} for g, spots in own.items()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array(lists, spotted)],
                names=["doc_id", "n", "h1", "h2", "grams"],
            )

    return docs.mapInArrow(made, "doc_id long, n long, h1 long, h2 long, grams array<struct<gram:long,spots:array<int>>>")


def classes_of(keys: DataFrame) -> DataFrame:
    """``n, h1, h2, rep, rows, grams``: equal texts, their least id and how many rows there are."""
    known = keys.where("doc_id IS NOT NULL").groupBy("n", "h1", "h2")
    return known.agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows"), F.first("grams").alias("grams"))


def shared_anchors(classes: DataFrame, length: int, across: bool) -> DataFrame:
    """``rep, grams`` (``spots``, and the windows that go together); ``across``: only grams of two texts or more."""
    listed = classes.select("rep", F.explode("grams").alias("g")).select("rep", "g.gram", "g.spots")
    counts = listed.groupBy("gram").agg(F.sum(F.size("spots")).alias("members"), F.min("rep").alias("low"), F.max("rep").alias("high"))
    kept = counts.where("low < high" if across else "members > 1")
    width = F.lit(1)
    for most, parts in reversed(TIERS):
        width = F.when(F.col("members") <= most, F.lit(max(1, length // parts) if parts else length)).otherwise(width)
    return listed.join(kept.select("gram", width.alias("width")), "gram").groupBy("rep").agg(F.collect_list(F.struct("spots", "width")).alias("grams"))


def records(rows: DataFrame, alphabet: type, length: int, gram: int, first_stays: bool) -> DataFrame:
    """``key, hull, content, windows, docs, starts`` for rows of ``doc_id, text, grams``.

    Members of equal hulls within a batch are settled at once (but for the least id, if that stays), and one of them goes
    on, without members if they are all settled. What is settled is a row a document with a null hull and the spans.
    """
    ddl = "key long, hull binary, content binary, windows int, docs array<long>, starts array<long>"
    schema = pa.schema([("key", pa.int64()), ("hull", pa.binary()), ("content", pa.binary()), ("windows", pa.int32()), ("docs", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64()))])

    def made(batches):
        for batch in batches:
            hulls: dict = {}
            settled: dict[int, list] = {}
            for id_, raw, grams in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("grams").to_pylist()):
                text = alphabet(raw)
                found = anchors(text, length, gram)
                for own in grams:
                    for spot in own["spots"]:
                        hash_, place, first, last = found[spot]
                        content = text.piece(first, last + length)
                        known = hulls.setdefault((hash_, content), (last - first + 1, place - first, own["width"], []))
                        known[3].append((id_, first))
            out = []
            for (hash_, content), (windows, offset, width, members) in hulls.items():
                hull, low = xxhash.xxh128_digest(content), min(members)[0]
                kept = [m for m in members if m[0] == low] if first_stays else members if len(members) == 1 else []
                for id_, start in members:
                    if id_ > low if first_stays else len(members) > 1:
                        settled.setdefault(id_, []).append({"start": start, "stop": start + windows - 1 + length})
                if width >= length:
                    out.append({"key": hash_, "hull": hull, "content": content, "windows": windows, "docs": [m[0] for m in kept], "starts": [m[1] for m in kept]})
                    continue
                text = alphabet(content)
                for g in range((offset - windows + 1) // width, offset // width + 1):  # windows start g * width to (g + 1) * width - 1 before the anchor
                    a, b = max(0, offset - (g + 1) * width + 1), min(windows - 1, offset - g * width)
                    if a > b:
                        continue
                    # all windows of the run hold these symbols, of which some may lie outside this hull's windows
                    core = text.piece(max(0, offset - g * width), offset - (g + 1) * width + 1 + length)
                    piece = text.piece(a, b + length)
                    docs, starts = [m[0] for m in kept], [m[1] + a for m in kept]
                    out.append({"key": xxhash.xxh64_intdigest(core, seed=g & 0xFFFF) - (1 << 63), "hull": xxhash.xxh128_digest(piece), "content": piece, "windows": b - a + 1, "docs": docs, "starts": starts})
            for id_, spans in settled.items():
                out.append({"key": id_, "hull": None, "content": None, "windows": 0, "docs": [id_], "starts": [x for span in merged(spans, False, 0) for x in span]})
            for i in range(0, len(out), 5000):
                yield pa.RecordBatch.from_pylist(out[i : i + 5000], schema=schema)

    return rows.mapInArrow(made, ddl)


def windows_of(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The content and the place of each window, for contents of so many symbols on end."""
    windows = np.maximum(sizes - length + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), windows)
    return owner, np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)


def resolved(found: DataFrame, index: Index, length: int, first_stays: bool) -> DataFrame:
    """``doc_id, start, stop``: symbols covered by windows that repeat.

    ``first_stays``: a window counts only if a smaller id has it; else if any other place has it.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])

    def spans(out):
        ids, starts, stops = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(stops, pa.int64())], schema=schema)

    def settle(groups, out):
        """Distinct hulls of whole groups: windows that another hull, or another place in this one, has as well."""
        # windows of one hull differ, as they have one anchor; hulls without members are settled
        groups = [g for g in groups if len(g) > 1 and any(h["open"] for h in g)]
        hulls = [h for g in groups for h in g]
        if not hulls:
            return
        # equal windows are of one group: a window has one anchor, and one core
        ids, owner, place = index([h["content"] for h in hulls], np.repeat(np.arange(len(groups)), [len(g) for g in groups]), length)
        size = int(ids.max()) + 1 if len(ids) else 0
        if first_stays:
            lowest = np.full(size, np.iinfo(np.int64).max)
            docs = np.array([h["docs"][0] for h in hulls], np.int64)
            np.minimum.at(lowest, ids, docs[owner])
            again = lowest[ids] < docs[owner]
        else:
            again = np.bincount(ids, minlength=size)[ids] > 1
        hit = np.flatnonzero(again)
        if not len(hit):
            return
        breaks = np.flatnonzero((np.diff(hit) > 1) | (np.diff(owner[hit]) > 0)) + 1
        for run in np.split(hit, breaks):
            hull = hulls[owner[run[0]]]
            if hull["open"]:
                out += [(d, s + int(place[run[0]]), s + int(place[run[-1]]) + length) for d, s in zip(hull["docs"], hull["starts"])]

    def made(batches):
        key = hull = now = None
        group, groups, held, out = [], [], 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["hull"] is None:
                    out += [(row["docs"][0], a, b) for a, b in zip(row["starts"][::2], row["starts"][1::2])]
                    continue
                if row["key"] != key:
                    if group:
                        groups.append(group)
                    group, key, hull = [], row["key"], None
                    if held > GROUP_BYTES:
                        settle(groups, out)
                        groups, held = [], 0
                stop = row["windows"] - 1 + length
                if row["hull"] != hull or row["content"] != now["content"]:
                    hull = row["hull"]
                    now = {"content": row["content"], "docs": [], "starts": [], "open": True}
                    group.append(now)
                    held += len(row["content"])
                    if first_stays:
                        now["docs"] = [d for d in row["docs"] if d == row["docs"][0]]
                        now["starts"] = row["starts"][: len(now["docs"])]
                        out += [(d, s, s + stop) for d, s in zip(row["docs"][len(now["docs"]) :], row["starts"][len(now["docs"]) :])]
                        continue
                    if len(row["docs"]) == 1:
                        now["docs"], now["starts"] = row["docs"], row["starts"]
                        continue
                    now["open"] = False
                    out += [(d, s, s + stop) for d, s in zip(row["docs"], row["starts"])]
                    continue
                # the same hull again, from another batch of texts
                if first_stays:
                    low = now["docs"][0]
                    for d, s in zip(row["docs"], row["starts"]):
                        if d > low:
                            out.append((d, s, s + stop))
                        else:
                            now["docs"].append(d)
                            now["starts"].append(s)
                else:
                    if now["open"]:
                        out += [(d, s, s + stop) for d, s in zip(now["docs"], now["starts"])]
                        now["open"], now["docs"], now["starts"] = False, [], []
                    out += [(d, s, s + stop) for d, s in zip(row["docs"], row["starts"])]
            if len(out) > 20_000:
                yield spans(out)
                out = []
        if group:
            groups.append(group)
        settle(groups, out)
        yield spans(out)

    dealt = found.repartition("key").sortWithinPartitions("key", "hull", F.get("docs", F.lit(0)))
    return dealt.mapInArrow(made, "doc_id long, start long, stop long")


def spans_of(docs: DataFrame, alphabet: type, index: Index, length: int, gram: int, first_stays: bool) -> DataFrame:
    """``doc_id, spans, all_gone`` of the texts that lose something; ``docs`` has ``doc_id, text``."""
    short_batches(docs.sparkSession)
    keys = stored(keyed(docs, alphabet, length, gram), "rp-keys")
    classes = stored(classes_of(keys), "rp-classes")
    spots = stored(shared_anchors(classes, length, first_stays), "rp-spots")
    texts = docs.join(spots, F.col("doc_id") == F.col("rep")).select("doc_id", "text", "grams")
    covered = resolved(records(texts, alphabet, length, gram, first_stays), index, length, first_stays)
    spans = covered.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    repeated = classes.where(F.col("n") >= length).where("rows > 1").select("n", "h1", "h2", "rep")
    gone = keys.select("doc_id", "n", "h1", "h2").join(repeated, ["n", "h1", "h2"]).where("doc_id > rep" if first_stays else "true").select("doc_id").distinct()
    return stored(spans.join(gone.withColumn("all_gone", F.lit(True)), "doc_id", "full").select("doc_id", "spans", F.coalesce("all_gone", F.lit(False)).alias("all_gone")), "rp-spans")


def merged(spans: list[dict] | None, all_gone: bool, n: int) -> list[tuple[int, int]]:
    """Maximal runs of covered symbols."""
    if all_gone:
        return [(0, n)] if n else []
    out: list[list[int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def removed(docs: DataFrame, spans: DataFrame, alphabet: type, row: Callable[[Bytes | Words, list[tuple[int, int]]], tuple], schema: str) -> DataFrame:
    """``doc_id`` and what ``row`` makes of each text and the runs that it loses."""
    joined = docs.join(spans.withColumnRenamed("doc_id", "__rp_id"), F.col("doc_id") == F.col("__rp_id"), "left").select("doc_id", "text", "spans", F.coalesce("all_gone", F.lit(False)).alias("all_gone"))
    names = ["doc_id", *[c.split()[0] for c in schema.split(", ")]]

    def made(batches):
        for batch in batches:
            out = []
            for id_, raw, own, gone in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans", "all_gone"))):
                text = alphabet(raw)
                out.append((id_, *row(text, merged(own, gone, len(text)))))
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out)))))

    return joined.mapInArrow(made, f"doc_id long, {schema}")

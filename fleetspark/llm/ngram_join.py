"""N-gram Jaccard join by T-occurrence search: groups of documents whose shingle sets are alike.

1. Each text becomes the set of its n-word shingles, as 64-bit hashes. Equal sets are one class, which its smallest id stands for.
2. Candidates: let a be the shingles that a set x may lack in a set it links with, |x| - ceil(t |x|). In any one order of
   all shingles, the first a + k shingles of two linked sets share k at least. So a set of whose first 1.25 a shingles
   too few are in any other set's is out (most are), and so is, of the rest, one of whose first 2 a + 1 too few are.
   What they share there is put in order of rarity, and of that a short prefix must be shared again: linked sets meet in one
   of its lists. The first order is by hash with common shingles, as a sample of documents tells them, last; it decides how
   much work there is, not what is found.
3. Stars: each set is compared with one other, the least document of its lists. A large group of near copies is linked by that
   alone, in time linear in it; lists whose sets are all linked by now are done.
4. Cells: the lists left are tied together, each by edges to its least document and never by all its pairs; the components of
   these edges are the cells of the search. No link leaves a cell.
5. Search: a cell's sets go to one task. There, for each set, DivideSkip: the short inverted lists are merged by a heap that
   skips documents which can't occur often enough (MergeSkip), those that do are probed in the long lists by binary search,
   and those that reach the required overlap are linked. Sets already linked, directly or not, are not compared. A cell of more
   than ``CELL_SHINGLES`` is cut into blocks and each pair of blocks is a task, but blocks of one group of linked sets don't
   meet; so memory stays bounded, a group however large meets the rest of its cell only, and nothing is left out.

Words are lower-cased A-Z runs of non-white-space bytes. Defined cases: a text with fewer than n words is one shingle of
all its words; without words (or null) it has no shingle and links with nothing. A null id stands for no document: the row gets its
class's smallest id. Rows with one id are one node. An empty table gives an empty result. Other columns are ignored. Ids are whole
numbers; one that can't be cast to a number is an error.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.llm.common import BROADCAST_BYTES, broadcast_if_small, short_batches, stored
from fleetspark.llm.graph import components

CELL_SHINGLES, STAR_SETS, JUMPS = 2_000_000, 2000, 2
#: How dear a step of the heap is beside a binary search, which decides how many lists are long.
HEAP_COST = 0.01
ORDER_SAMPLE, ORDER_SHARE, ORDER_MOST = 5000, 0.002, 200_000
#: Words whose hashes a worker keeps, and the bytes of the longest of them.
CACHE_WORDS, CACHED_BYTES = 150_000, 64
_TIMES, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _Hashes(dict):
    """64-bit hashes of words, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(word) <= CACHED_BYTES:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = found
        return found


_HASHES = _Hashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def shingles(text: str | None, n: int) -> np.ndarray:
    """The sorted distinct shingles of a text, as signed 64-bit hashes."""
    hashes = word_hashes((text or "").encode().lower().split())
    if not len(hashes):
        return np.zeros(0, np.int64)
    width = min(n, len(hashes))
    count = len(hashes) - width + 1
    rolled = np.full(count, np.uint64(width))
    for i in range(width):
        rolled = rolled * _TIMES + hashes[i : i + count]
    rolled = (rolled ^ (rolled >> np.uint64(30))) * _MIX1
    rolled = (rolled ^ (rolled >> np.uint64(27))) * _MIX2
    return np.unique((rolled ^ (rolled >> np.uint64(31))).view(np.int64))


def common_shingles(docs: DataFrame, n: int, rows: int) -> np.ndarray:
    """Shingles in at least ``ORDER_SHARE`` of about ``ORDER_SAMPLE`` documents: at most ``ORDER_MOST``, sorted."""
    every = max(1, rows // ORDER_SAMPLE)
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("text")

    def listed(batches):
        for batch in batches:
            sets = [shingles(t, n) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets or [np.zeros(0, np.int64)]))], names=["shingle"])

    counts = sample.mapInArrow(listed, "shingle long").groupBy("shingle").count()
    least = max(10, int(min(rows, ORDER_SAMPLE) * ORDER_SHARE))
    found = counts.where(F.col("count") >= least).orderBy(F.desc("count"), "shingle").limit(ORDER_MOST).select("shingle").toArrow()
    return np.sort(found.column("shingle").to_numpy())


def _lacking(size, percent: int):
    """How many of ``size`` shingles a set that links may lack."""
    return size - -(-percent * size // 100)


def _keys(docs: DataFrame, n: int, percent: int, common: np.ndarray, times: float) -> DataFrame:
    """``doc_id, size, h1, h2, prefix`` of each row; the prefix has ``times`` the shingles that may lack, and one more at least."""

    def keyed(batches):
        for batch in batches:
            sizes, first, second, prefixes = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, n)
                digest = np.frombuffer(xxhash.xxh128_digest(found.tobytes()), np.int64)
                at = np.minimum(np.searchsorted(common, found), max(0, len(common) - 1))
                is_common = common[at] == found if len(common) else np.zeros(len(found), bool)
                lacking = _lacking(len(found), percent)
                keep = max(lacking + 2, int(lacking * times) + 1)
                sizes.append(len(found))
                first.append(int(digest[0]))
                second.append(int(digest[1]))
                prefixes.append(np.concatenate((found[~is_common][:keep], found[is_common][:keep]))[:keep])
            ends = np.cumsum([0] + [len(p) for p in prefixes]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(prefixes or [np.zeros(0, np.int64)]), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), lists],
                names=["doc_id", "size", "h1", "h2", "prefix"],
            )

    return docs.mapInArrow(keyed, "doc_id long, size long, h1 long, h2 long, prefix array<long>")


def _shared(keys: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The shingles of prefixes that several sets have (``rep, shingle, n``), and the sets of whose prefix enough are (``rep, size, length, shared``)."""
    lists = keys.select("rep", F.explode("prefix").alias("shingle"))
    several = lists.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    kept = lists.join(several, "shingle")
    sizes = keys.select("rep", "size", F.size("prefix").alias("length"))
    alive = kept.groupBy("rep").agg(F.count("*").alias("shared")).join(sizes, "rep")
    lacking = F.col("size") - F.ceil(F.col("size") * percent / 100)
    return kept, alive.where(F.col("shared") >= F.col("length") - lacking)


def _rare_lists(rows: DataFrame, keys: DataFrame, n: int, percent: int, common: np.ndarray, broadcast_bytes: int) -> DataFrame:
    """``rep, shingle``: short lists, in one of which any two linked sets meet."""
    first = stored(_shared(keys, percent)[1].select(F.col("rep").alias("__nj_rep")), "nj-first")
    left = rows.join(broadcast_if_small(first, most=broadcast_bytes), F.col("doc_id") == F.col("__nj_rep")).select("doc_id", "text")
    longer = stored(_keys(left, n, percent, common, 2.0).dropDuplicates(["doc_id", "h1", "h2"]).select(F.col("doc_id").alias("rep"), "size", "prefix"), "nj-longer")
    kept, alive = _shared(longer, percent)
    # a partner has percent of the size at least; of two prefixes as many are shared as the smaller set may lack, and one
    lacking = F.col("size") - F.ceil(F.col("size") * percent / 100)
    smaller = F.ceil(F.col("size") * percent / 100)
    both = smaller - F.ceil(smaller * percent / 100) + 1
    # shingles of this set alone would come first in the order of rarity
    span = F.greatest(F.lit(1), F.col("length") - F.least(both, F.col("length") - lacking) + 1) - (F.col("length") - F.col("shared"))
    ranked = kept.join(alive.select("rep", span.alias("span")), "rep")
    rank = F.row_number().over(Window.partitionBy("rep").orderBy("n", "shingle"))  # a set's own prefix: as long as its text at most
    return stored(ranked.withColumn("rank", rank).where("rank <= span").select("rep", "shingle"), "nj-rare")


def occurring(lists: list[list[int]], least: int) -> list[tuple[int, int]]:
    """(document, occurrences) of those in ``least`` of the ascending lists or more: a heap of the lists' heads, and skips (MergeSkip)."""
    heap = [(own[0], k, 0) for k, own in enumerate(lists) if own]
    heapq.heapify(heap)
    out = []
    while len(heap) >= least:
        now, popped = heap[0][0], []
        while heap and heap[0][0] == now:
            popped.append(heapq.heappop(heap))
        if len(popped) >= least:
            out.append((now, len(popped)))
            then = now + 1
        else:  # what is before the head of the least-th list can't occur often enough
            for _ in range(min(least - 1 - len(popped), len(heap))):
                popped.append(heapq.heappop(heap))
            if not heap:
                break
            then = heap[0][0]
        for _, k, at in popped:
            own = lists[k]
            at = bisect_left(own, then, at)
            if at < len(own):
                heapq.heappush(heap, (own[at], k, at))
    return out


class Cell:
    """Sets of one cell and their inverted lists; ``links`` joins what is alike. Sets of one of ``groups`` are joined before."""

    def __init__(self, sets: list[np.ndarray], percent: int, left: np.ndarray | None = None, groups: np.ndarray | None = None):
        self.percent, self.count = percent, len(sets)
        order = np.argsort([len(s) for s in sets], kind="stable")
        self.order, self.sizes = order, np.array([len(sets[i]) for i in order], np.int64)
        #: Of a pair of blocks, which sets are of the first; None if all pairs count.
        self.left = None if left is None else left[order]
        numbers, place = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
        owner = np.repeat(np.arange(self.count), self.sizes)
        self.pairs = np.sort(place * self.count + owner)  # (shingle, document), shingle by shingle
        lengths = np.bincount(place, minlength=len(numbers))
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.docs = self.pairs % self.count
        starts = np.cumsum(self.sizes) - self.sizes
        self.own = [np.sort(place[a : a + n]) for a, n in zip(starts, self.sizes)]
        self.parent = np.arange(self.count)
        if groups is not None:
            _, first, group = np.unique(groups[order], return_index=True, return_inverse=True)
            self.parent = first[group]
        self.apart = int((self.parent == np.arange(self.count)).sum())

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def roots(self, xs: np.ndarray) -> np.ndarray:
        up = self.parent[xs]
        while not np.array_equal(up, higher := self.parent[up]):
            up = higher
        return up

    def candidates(self, x: int, lists: np.ndarray) -> list[list[int]]:
        """Of each list, the sets after ``x`` that are small enough and not yet joined with it."""
        most = int(np.searchsorted(self.sizes, self.sizes[x] * 100 // self.percent, side="right"))
        spans = [self.docs[a:b] for a, b in zip(self.starts[lists], self.ends[lists])]
        ends = np.cumsum([len(s) for s in spans])
        all_ = np.concatenate(spans)
        good = (all_ > x) & (all_ < most)
        if self.left is not None:
            good[good] = self.left[all_[good]] != self.left[x]
        good[good] = self.roots(all_[good]) != self.root(x)
        counts = np.append(0, np.cumsum(good))[np.append(0, ends)]
        kept = all_[good].tolist()
        return [kept[a:b] for a, b in zip(counts, counts[1:])]

    def search(self, x: int) -> list[int]:
        """The sets after ``x`` (no smaller) that are alike and not yet joined with it."""
        size, percent = int(self.sizes[x]), self.percent
        least = -(-2 * percent * size // (100 + percent))  # the overlap that a set of the same size needs
        lists = self.own[x]
        lengths = self.ends[lists] - self.starts[lists]
        lists, lengths = lists[np.argsort(lengths, kind="stable")], np.sort(lengths)
        live = int(np.searchsorted(lengths, 1, side="right"))  # lists of x alone
        if size - live < least:
            return []
        long = min(least - 1, int(least / (HEAP_COST * math.log2(lengths[-1]) + 1)))
        split = size - long
        if split <= live:
            return []
        short = occurring(self.candidates(x, lists[live:split]), least - long)
        if not short:
            return []
        found, counts = np.array(short, np.int64).T
        wanted = lists[split:, None] * self.count + found[None, :]
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        overlap = counts + (self.pairs[at] == wanted).sum(axis=0)
        return found[100 * overlap >= percent * (size + self.sizes[found] - overlap)].tolist()

    def links(self) -> list[tuple[int, int]]:
        """A forest of links, as places in the list of sets."""
        made = []
        for x in range(self.count):
            if self.apart == 1:
                break
            for y in self.search(x):
                a, b = self.root(x), self.root(y)
                if a != b:
                    self.parent[max(a, b)] = min(a, b)
                    self.apart -= 1
                    made.append((int(self.order[x]), int(self.order[y])))
        return made


def _dealt_sets(rows: DataFrame, n: int) -> DataFrame:
    """``doc_id, shingles`` and the fields of the spots of ``rows`` (doc_id, text, spots), a row a spot."""

    def sets(batches):
        for batch in batches:
            found = [shingles(t, n) for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0] + [len(p) for p in found]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found or [np.zeros(0, np.int64)]), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("spots"), lists], names=["doc_id", "spots", "shingles"])

    spots = rows.schema["spots"].dataType.simpleString()
    made = rows.mapInArrow(sets, f"doc_id long, spots {spots}, shingles array<long>")
    return made.select("doc_id", "shingles", F.explode("spots").alias("s")).select("doc_id", "shingles", "s.*")


def _arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
    lists = batch.column("shingles")
    values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets, offsets[1:])]


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})


def _with_heads(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) of sets with the head of their star: ``rows`` has doc_id, text and spots (head, part, member)."""

    def compared(batches):
        at, head = None, np.zeros(0, np.int64)
        for batch in batches:
            out = []
            for now, part, id_, own in zip(batch.column("head").to_pylist(), batch.column("part").to_pylist(), batch.column("doc_id").to_pylist(), _arrays(batch)):
                if id_ == now:
                    at, head = (now, part), own.copy()
                elif at == (now, part):
                    both = len(np.intersect1d(head, own, assume_unique=True))
                    if 100 * both >= percent * (len(head) + len(own) - both):
                        out.append((id_, now))
            yield _links(out)

    dealt = _dealt_sets(rows, n).repartition("head", "part").sortWithinPartitions("head", "part", "member")
    return dealt.select("doc_id", "head", "part", "shingles").mapInArrow(compared, "a long, b long")


def _searched(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) of the cells of ``rows``: doc_id, text and spots (cell, i, j, block, linked); i = j where all pairs of a block count."""

    def solve(key, ids, found, blocks, linked):
        left = np.array(blocks) == blocks[0] if key[1] != key[2] else None
        return [(ids[a], ids[b]) for a, b in Cell(found, percent, left, np.array(linked)).links()]

    def searched(batches):
        key, held, out = None, ([], [], [], []), []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("cell", "i", "j"))))
            for now, id_, own, block, linked in zip(keys, batch.column("doc_id").to_pylist(), _arrays(batch), batch.column("block").to_pylist(), batch.column("linked").to_pylist()):
                if now != key:
                    if len(held[0]) > 1:
                        out += solve(key, *held)
                    key, held = now, ([], [], [], [])
                for column, value in zip(held, (id_, own.copy(), block, linked)):
                    column.append(value)
            if len(out) > 10_000:
                yield _links(out)
                out = []
        if len(held[0]) > 1:
            out += solve(key, *held)
        yield _links(out)

    dealt = _dealt_sets(rows, n).repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "block", "doc_id")
    return dealt.select("doc_id", "cell", "i", "j", "block", "linked", "shingles").mapInArrow(searched, "a long, b long")


def _star_spots(rare: DataFrame, star_sets: int) -> DataFrame:
    """``member, spots``: each set at the least of its lists' heads, in parts of ``star_sets``; a head stands in all parts of its star."""
    heads = rare.groupBy("shingle").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where("n > 1").select("shingle", "head")
    least = stored(rare.join(heads, "shingle").where("rep <> head").groupBy("rep").agg(F.min("head").alias("head")), "nj-stars")
    parts = least.groupBy("head").agg((F.floor(F.count("*") / star_sets) + 1).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    spot = F.struct("head", part.alias("part"), F.lit(True).alias("member"))
    members = least.join(parts, "head").select("rep", F.array(spot).alias("spots"))
    all_parts = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(F.col("head"), p.alias("part"), F.lit(False).alias("member")))
    both = members.unionByName(parts.select(F.col("head").alias("rep"), all_parts.alias("spots")))
    return both.groupBy(F.col("rep").alias("member")).agg(F.flatten(F.collect_list("spots")).alias("spots"))  # two rows an id at most


def _star_labels(starred: DataFrame) -> DataFrame:
    """``node, linked``: the head that a set's links lead to in ``1 + JUMPS`` steps. Sets of one label are linked; of linked sets some may have two."""
    once = stored(starred.groupBy("a").agg(F.min("b").alias("b")), "nj-steps")  # rows that share an id are one node
    steps = once.select(F.col("a").alias("node"), F.col("b").alias("linked"))
    up = once.select(F.col("a").alias("__nj_at"), F.col("b").alias("__nj_up"))
    for _ in range(JUMPS):
        steps = steps.join(up, F.col("linked") == F.col("__nj_at"), "left").select("node", F.coalesce("__nj_up", "linked").alias("linked"))
    return steps


def _cell_spots(cells: DataFrame, sizes: DataFrame, linked: DataFrame, cell_shingles: int) -> DataFrame:
    """``member, spots``: the pairs of blocks that each set of a cell goes to.

    Small groups of linked sets share blocks by the group's hash; one of more than half a cell's bound has blocks of its own,
    which don't meet one another. A task sees two blocks, so a block holds half of a cell's bound.
    """
    most = max(1, cell_shingles // 2)
    sized = cells.join(sizes, F.col("node") == F.col("rep")).join(linked, "node", "left").select("node", F.col("component").alias("cell"), "size", F.coalesce("linked", "node").alias("linked"))
    sized = stored(sized, "nj-sized")
    groups = sized.groupBy("cell", "linked").agg(F.sum("size").alias("load"))
    loads = groups.groupBy("cell").agg(F.sum("load").alias("all"), F.sum(F.when(F.col("load") <= most, F.col("load")).otherwise(0)).alias("small"))
    shared = F.when(F.col("all") <= cell_shingles, 1).otherwise(F.floor(F.col("small") / most) + 1).cast("int")
    loads = loads.select("cell", shared.alias("shared"), (F.col("all") > cell_shingles).alias("cut"))
    groups = stored(groups, "nj-linked")
    large = groups.where(F.col("load") > most).join(loads.where("cut"), "cell").withColumn("own", F.ceil(F.col("load") / most).cast("int"))
    in_cell = Window.partitionBy("cell").orderBy("linked")  # a row for each large group of a cell
    large = large.select("cell", "linked", "own", (F.sum("own").over(in_cell) - F.col("own")).cast("int").alias("skip"))
    totals = large.groupBy("cell").agg(F.sum("own").cast("int").alias("large"))
    placed = sized.join(loads, "cell").join(totals, "cell", "left").join(large, ["cell", "linked"], "left")
    first = F.col("shared") + F.col("skip")
    block = F.when(F.col("own").isNull(), F.pmod(F.xxhash64("linked"), F.col("shared"))).otherwise(first + F.pmod(F.xxhash64("node"), F.col("own"))).cast("int")
    placed = placed.withColumn("block", block).withColumn("blocks", F.col("shared") + F.coalesce("large", F.lit(0)))
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.col("own").isNull() | (o < first) | (o >= first + F.col("own")))
    spots = F.transform(others, lambda o: F.struct("cell", F.least("block", o).alias("i"), F.greatest("block", o).alias("j"), "block", "linked"))
    return placed.select(F.col("node").alias("member"), spots.alias("spots"))


def alike(
    docs: DataFrame,
    n: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    cell_shingles: int = CELL_SHINGLES,
    star_sets: int = STAR_SETS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row: documents link if 100 |x & y| >= percent |x | y|."""
    spark = docs.sparkSession
    short_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    common = common_shingles(rows, n, rows.count())
    keys = stored(_keys(rows, n, percent, common, 1.25), "nj-keys")
    named = keys.where("size > 0 AND doc_id IS NOT NULL")
    classes = stored(named.groupBy("size", "h1", "h2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows")), "nj-classes")
    copies = named.select("doc_id", "size", "h1", "h2").join(classes.where("rows > 1"), ["size", "h1", "h2"]).where("doc_id <> rep").select(F.col("doc_id").alias("__nj_copy")).distinct()
    copies = broadcast_if_small(stored(copies, "nj-copies"), most=broadcast_bytes)
    alone = named.join(copies, F.col("doc_id") == F.col("__nj_copy"), "left_anti").select(F.col("doc_id").alias("rep"), "size", "prefix")
    rare = _rare_lists(rows, alone, n, percent, common, broadcast_bytes)

    def at_spots(spots: DataFrame) -> DataFrame:
        side = broadcast_if_small(spots, F.lit(48) + 48 * F.size("spots"), broadcast_bytes)
        return rows.join(side, F.col("doc_id") == F.col("member")).select("doc_id", "spots", "text")

    starred = stored(_with_heads(at_spots(stored(_star_spots(rare, star_sets), "nj-star-spots")), n, percent), "nj-starred")
    linked = stored(_star_labels(starred), "nj-star-groups")

    lists = rare.join(linked, F.col("rep") == F.col("node"), "left").select("rep", "shingle", F.coalesce("linked", "rep").alias("linked"))
    open_ = lists.groupBy("shingle").agg(F.min("rep").alias("head"), F.min("linked").alias("low"), F.max("linked").alias("high")).where("low < high")
    edges = lists.join(open_.select("shingle", "head"), "shingle").where("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b"))
    cells = stored(components(edges), "nj-cells")
    sizes = classes.groupBy("rep").agg(F.sum("size").alias("size"))
    searched = stored(_searched(at_spots(stored(_cell_spots(cells, sizes, linked, cell_shingles), "nj-members")), n, percent), "nj-links")
    groups = stored(components(starred.unionByName(searched)), "nj-groups")

    ranked = keys.join(classes.select("h1", "h2", "size", "rep"), ["h1", "h2", "size"], "left")
    found = ranked.join(groups, F.col("rep") == F.col("node"), "left")
    return found.select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with only the smallest id of each component; rows with a null id stay, as no decision can name them."""
    found = alike(docs, n, percent, id_col, text_col)
    dropped = stored(found.where("doc_id IS NOT NULL AND component_id <> doc_id").select(F.col("doc_id").alias("__nj_id")).distinct(), "nj-dropped")
    return docs.join(broadcast_if_small(dropped), F.col(id_col) == F.col("__nj_id"), "left_anti")

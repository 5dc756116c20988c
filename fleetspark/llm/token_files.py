"""Token ids in ORC files: integer run lengths, row indexes and Bloom filters on document ids.

``write_tokens`` deals texts out by ranges of ids, encodes each range in order and writes one ORC file a range:

    ids/part-*.orc   doc_id, part, at, stop, n_tokens, ids     in ascending order of doc_id
    parts/*.orc      part, docs, tokens, first_id, last_id, start     one row a file

``ids`` and all counts are run-length coded integers. ``at`` and ``stop`` are where a document begins and ends in its part, ``start``
where a part begins in the whole, so no row needs a sum over the rows before it and a place in the whole is found from ``parts`` alone.
Spark's readers take stripes in parallel, read only the columns that are asked for, and leave out stripes and row groups: by minima
and maxima for ranges (``read_span``), by Bloom filters for single ids (``read_documents``).

What stands between two places where a text may be cut is encoded by the library once (see ``chunks``). A text may be cut at every space: the tokenizers meant here drop white
space, compose and lower letters by themselves, and no special token holds a space, so they don't look across one. Pass
``cut_at_spaces=False`` for others; their texts are then encoded whole.

Defined cases: a null text is empty and has the end id alone; a null id comes first; rows that share an id lie in the order of their
texts' hash, and rows alike in both are written each. An empty table gives no document. A text of any length is encoded in slabs and
written as one row. Names of other columns don't matter, as only the two are read. Ranges are dealt out by id and hash of the text, so
a repeated id doesn't fill one task; a task sorts its range on disk if need be and holds one batch.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetspark.llm import chunks
from fleetspark.llm.alignment import byte_letters
from fleetspark.llm.common import broadcast_if_small, short_batches, whole

#: Bytes of a stripe before compression, rows of a row group, and the share of other ids that a Bloom filter lets pass.
STRIPE_BYTES, GROUP_ROWS, FALSE_SHARE = 16 << 20, 1000, 0.01
#: Rows that a reader of ids holds at once, and rows after which a writer looks whether its stripe is full.
READ_ROWS, CHECK_ROWS = 512, 100


#: How the tokenizer of words cuts a text, by its file. Only for files that say so are short words cut here.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: What a simple text doesn't hold: in one nothing composes, no letter's case depends on its neighbours and no special token can be.
_OTHER = re.compile(r"[^\n\t -;=-~À-ÖØ-öø-ÿ]+")
#: The pieces of a simple text in lower case.
_SIMPLE_PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^\n\t 0-9a-zß-öø-ÿ]+")
#: Bytes that a kept encoding takes beside its key and ids.
KEPT_ENTRY = 180


class Pieces(dict):
    """Ids of pieces in lower case, encoded by a model of the library when first asked for; ``held`` is about what they take."""

    def __init__(self, model):
        self.tokenize, self.held = model.tokenize, 0
        self.letters = {b: c for c, b in byte_letters().items()}

    def __missing__(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        ids = self[piece] = array("i", [t.id for t in self.tokenize(letters)]).tobytes()
        self.held += KEPT_ENTRY + len(piece) + len(ids)
        return ids


class WordIds:
    """Encodings of texts by a file of the tokenizers library, as little-endian 32-bit ids.

    A stretch of ASCII and Latin-1 characters is cut by the file's own pattern, in short, and the library's model encodes each new piece:
    pieces are far fewer than words, which differ by their case and marks. A word that holds other characters goes through the library whole.
    """

    def __init__(self, path: str, cut_at_spaces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library, self.cut_at_spaces = Tokenizer.from_file(path), cut_at_spaces
        said = json.loads(self.library.to_str())
        cut, bytes_ = ((said["pre_tokenizer"] or {}).get("pretokenizers") or [{}, {}])[:2]
        normal = [n["type"] for n in (said["normalizer"] or {}).get("normalizers", [])]
        self.simple = normal == _NORMALIZERS and cut.get("pattern") == {"Regex": _PIECES} and bytes_.get("type") == "ByteLevel" and said["model"]["type"] == "BPE"
        self.simple &= all("<" in t["content"] for t in said["added_tokens"])
        self.words: dict[str, bytes] = {}
        self.pieces = Pieces(self.library.model)
        self.held = 0

    @staticmethod
    @lru_cache(maxsize=4)
    def of(path: str, cut_at_spaces: bool) -> WordIds:
        return WordIds(path, cut_at_spaces)

    def encoded(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<i4").tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def cut(self, text: str) -> bytes:
        """The ids of a simple text."""
        return b"".join(map(self.pieces.__getitem__, _SIMPLE_PIECES.findall(text.lower())))

    def parts(self, text: str) -> list[tuple[bool, str]]:
        """What a text consists of, in order: other words, and the simple stretches between them, marked as such."""
        if not self.simple:
            return [(False, word) for word in text.split(" ")]
        found, at = [], 0
        for other in _OTHER.finditer(text):
            if other.start() < at:
                continue
            start, stop = max(at, text.rfind(" ", at, other.start()) + 1), text.find(" ", other.end())
            if start > at + 1:  # not a space alone
                found.append((True, text[at:start]))
            at = stop if stop >= 0 else len(text)
            found.append((False, text[start:at]))
        found.append((True, text[at:]))
        return found

    def forget(self) -> None:
        """When too much is kept, all goes."""
        if self.held + self.pieces.held > chunks.KEPT_BYTES:
            self.words.clear()
            self.pieces.clear()
            self.held = self.pieces.held = 0

    def learn(self, words: set[str]) -> None:
        """Encode the new ones of words."""
        fresh = words.difference(self.words)
        whole_ = [word for word in fresh if not self.simple or _OTHER.search(word)]
        made = {word: self.cut(word) for word in fresh.difference(whole_)} | dict(zip(whole_, self.encoded(whole_)))
        self.words.update(made)
        self.held += sum(KEPT_ENTRY + len(word) + len(ids) for word, ids in made.items())

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if not self.cut_at_spaces:
            return self.encoded(texts)
        found: list[list[bytes]] = [[] for _ in texts]
        for group in chunks.slabs(texts, lambda text, at: (space + 1 if (space := text.find(" ", at)) >= 0 else len(text))):
            self.forget()
            cut = [self.parts(stretch) for _, stretch in group]
            self.learn({part for parts in cut for simple, part in parts if not simple})
            for (place, _), parts in zip(group, cut):
                found[place] += [self.cut(part) if simple else self.words[part] for simple, part in parts]
        return [b"".join(parts) for parts in found]


def write_tokens(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None, cut_at_spaces: bool = True
) -> None:
    """Encode and write a table; ``end_id`` is appended to each document. Without ``partitions`` there are as many ranges as Spark shuffles into."""
    spark = docs.sparkSession
    short_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text")).withColumn("__tf_hash", F.xxhash64("text"))
    ranges = rows.repartitionByRange(*([partitions] if partitions else []), "doc_id", "__tf_hash").sortWithinPartitions("doc_id", "__tf_hash", "text").select("doc_id", "text")
    columns = {"doc_id": rows.schema["doc_id"].dataType, "part": T.IntegerType(), "at": T.LongType(), "stop": T.LongType(), "n_tokens": T.IntegerType(), "ids": T.ArrayType(T.IntegerType())}
    schema = T.StructType([T.StructField(name, kind) for name, kind in columns.items()])

    def encode(batches):
        library, part, at = WordIds.of(tokenizer_path, cut_at_spaces), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<i4").tobytes()
        for batch in batches:
            ids = [x + end for x in library.encode(batch["text"].to_pylist())]
            counts = np.array([len(x) // 4 for x in ids], np.int64)
            edges = at + chunks.before(counts)
            held = pa.ListArray.from_arrays(pa.array(edges - at, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))
            columns = [batch["doc_id"], pa.array(np.full(len(ids), part), pa.int32()), pa.array(edges[:-1]), pa.array(edges[1:]), pa.array(counts, pa.int32()), held]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
            at = int(edges[-1])

    settings = {"orc.stripe.size": STRIPE_BYTES, "orc.row.index.stride": GROUP_ROWS, "orc.rows.between.memory.checks": CHECK_ROWS}
    settings |= {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": FALSE_SHARE, "compression": "zstd"}
    ranges.mapInArrow(encode, schema).write.options(**settings).orc(f"{path}/ids")
    parts = spark.read.schema(schema).orc(f"{path}/ids").groupBy("part").agg(F.count("*").alias("docs"), F.max("stop").alias("tokens"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    parts.withColumn("start", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))).write.orc(f"{path}/parts")


def _ids(spark: SparkSession, path: str) -> DataFrame:
    spark.conf.set("spark.sql.orc.columnarReaderBatchSize", str(READ_ROWS))
    return spark.read.orc(f"{path}/ids")


def _parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(f"{path}/parts")


def _with_starts(rows: DataFrame, parts: DataFrame) -> DataFrame:
    starts = broadcast_if_small(parts.select("part", "start"))
    return rows.join(starts, "part").select("doc_id", (F.col("start") + F.col("at")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids``: ``start`` is the number of ids of all documents before. What isn't selected isn't read."""
    return _with_starts(_ids(spark, path), _parts(spark, path))


def read_documents(spark: SparkSession, path: str, wanted: list) -> DataFrame:
    """``read_tokens`` for some ids: row groups whose minima, maxima or Bloom filter exclude them all are not read."""
    return _with_starts(_ids(spark, path).where(F.col("doc_id").isin(wanted)), _parts(spark, path))


def read_span(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """``doc_id, start, ids``: ids ``start`` to ``stop`` of the whole, cut at both ends; row groups outside are not read."""
    parts = _parts(spark, path)
    touched = parts.where((F.col("start") < stop) & (F.col("start") + F.col("tokens") > start))
    ends = touched.agg(F.min(F.struct("part", "start")).alias("low"), F.max(F.struct("part", "start")).alias("high")).first()
    rows = _ids(spark, path)
    if ends["low"] is None or start >= stop:
        return _with_starts(rows.where("false"), parts).select("doc_id", "start", "ids")
    (low, low_start), (high, high_start) = ends["low"], ends["high"]
    near = rows.where(F.col("part").between(low, high) & ((F.col("part") != low) | (F.col("stop") > start - low_start)) & ((F.col("part") != high) | (F.col("at") < stop - high_start)))
    skip = F.greatest(F.lit(0), F.lit(start) - F.col("start"))
    length = F.least(F.col("n_tokens"), F.lit(stop) - F.col("start")) - skip
    return _with_starts(near, parts).select("doc_id", (F.col("start") + skip).alias("start"), F.slice("ids", (skip + 1).cast("int"), length.cast("int")).alias("ids"))


def ids_crc32(ids: Column) -> Column:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""

    @F.pandas_udf("long")
    def crc(lists: pd.Series) -> pd.Series:
        return lists.map(lambda x: zlib.crc32(np.ascontiguousarray(x, "<i4").tobytes()))

    return crc(ids)

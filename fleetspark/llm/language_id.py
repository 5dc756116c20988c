"""Language ID by compression: the language whose dictionary compresses a text best.

``fit`` fills one raw-content dictionary a language with whole texts of labelled rows: of at most ``SAMPLE_DOCS`` rows a language,
by the hash of their id and text, those that fit into ``DICTIONARY_BYTES``. ``identify`` lower-cases a whole text, keeps its letters
and their marks, cuts it into pieces of even length, and compresses each, ``REPEATS`` times over so that short ones fill a
block, with each dictionary; the smallest sum of sizes wins. On a tie the pieces are compressed at other numbers of repeats as
well. The score is the margin (second - best) / second. A text is rejected if its margin is at most ``MIN_MARGIN``, or if more
than ``MIXED`` of its pieces are won by other languages by as much. Both are asked of full evidence, that is pieces that compress to
``FULL_BYTES`` or more; pieces that tell less, as short or repetitive ones do, need a margin smaller in proportion.

Defined cases: a text that is null or has no letters (of category L) is ``und`` with score 0 and rejected; ties that stay go to the
language that is first in the alphabet, and are rejected; labelled rows without letters, or no labelled rows at all, teach nothing (then
all is ``und``). Rows that repeat a text teach it once. Ids only choose the sample; null ids and repeated ones are like others.
Memory is one Arrow batch and one piece; every row is on its own, so nothing is shuffled but hashes of a bounded sample.
"""

from __future__ import annotations

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import least_hashed, short_batches, within

SAMPLE_DOCS, DICTIONARY_BYTES = 256, 64 << 10
PIECE_BYTES, REPEATS, LEVEL = 512, 6, 6
#: Further numbers of repeats that settle a tie.
TIE_REPEATS = (2, 3, 5, 8, 12)
#: The margin that a text of full evidence needs, fitted on rows not held out; one of less needs as much less.
MIN_MARGIN, FULL_BYTES = 0.03, 192
#: A text is mixed if more than this share of its pieces is clearly in other languages than the whole.
MIXED = 0.4

_LETTER, _NOT_LETTERS = regex.compile(r"\p{L}"), regex.compile(r"[^\p{L}\p{M}]+")


def letters(text: str | None) -> bytes:
    """A text's words in lower case, all else as one space; empty without a letter."""
    lower = (text or "").lower()
    return _NOT_LETTERS.sub(" ", lower).strip().encode() if _LETTER.search(lower) else b""


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Dictionaries by language; what reaches the driver are the sampled rows' sizes and ``DICTIONARY_BYTES`` of texts a language."""
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    at = F.xxhash64(id_col, text_col)
    hashed = known.select(F.col(lang_col).alias("lang"), at.alias("at"), F.octet_length(text_col).alias("size"))
    sample = least_hashed(hashed.where(F.col("size") <= DICTIONARY_BYTES), "lang", "at", SAMPLE_DOCS)
    fits = within(sample.select("lang", "size", "at").orderBy("lang", "at").collect(), DICTIONARY_BYTES)
    chosen = labelled.sparkSession.createDataFrame([(r["lang"], r["at"]) for r in fits], "__lang string, __at long")
    matches = (F.col(lang_col) == F.col("__lang")) & (at == F.col("__at"))
    rows = known.join(F.broadcast(chosen), matches).groupBy("__lang", "__at").agg(F.min(text_col).alias("text")).orderBy("__lang", "__at").collect()  # as many rows as fit
    texts: dict[str, dict[bytes, None]] = {}
    for row in rows:
        if cleaned := letters(row["text"]):
            texts.setdefault(row["__lang"], {})[cleaned] = None
    return {lang: b" ".join(found) for lang, found in sorted(texts.items())}


class Identifier:
    """Compressors of one Python worker."""

    _made: dict[int, "Identifier"] = {}

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = list(dictionaries)
        self.compressors = []
        for data in dictionaries.values():
            made = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False))

    @classmethod
    def of(cls, dictionaries: dict[str, bytes]) -> "Identifier":
        key = hash(tuple(dictionaries.items()))
        if key not in cls._made:
            cls._made = {key: cls(dictionaries)}
        return cls._made[key]

    def __call__(self, text: str | None, min_margin: float = MIN_MARGIN) -> tuple[str, float, bool]:
        data = letters(text)
        if not data or not self.langs:
            return "und", 0.0, True
        count = -(-len(data) // PIECE_BYTES)
        step = -(-len(data) // count)
        pieces = [data[i : i + step] for i in range(0, len(data), step)]
        by_piece = [self.sizes(c, pieces, REPEATS) for c in self.compressors]
        sizes = [sum(found) for found in by_piece]
        for times in TIE_REPEATS:
            if len(sizes) < 2 or sizes.count(min(sizes)) == 1:
                break
            sizes = [size + sum(self.sizes(c, pieces, times)) for size, c in zip(sizes, self.compressors)]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = sizes[:best] + sizes[best + 1 :]
        if not others:
            return self.langs[best], 1.0, False
        score = (min(others) - sizes[best]) / min(others)
        by_column = list(zip(*by_piece))
        told = sum(min(found[:best] + found[best + 1 :]) for found in by_column) / len(pieces)
        needed = min_margin * min(1.0, told / FULL_BYTES)
        elsewhere = sum(min(found) < (1 - min_margin * min(1.0, found[best] / FULL_BYTES)) * found[best] for found in by_column)
        return self.langs[best], score, score <= needed or elsewhere > MIXED * len(pieces)

    @staticmethod
    def sizes(compressor: zstandard.ZstdCompressor, pieces: list[bytes], times: int) -> list[int]:
        return [len(compressor.compress(b" ".join([piece] * times))) for piece in pieces]


def identify(text: Column, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN) -> Column:
    """A struct of ``lang_pred``, ``score`` and ``rejected`` for a text column."""

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([Identifier.of(dictionaries)(text, min_margin) for text in texts], columns=["lang_pred", "score", "rejected"])

    return predicted(text)


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def label(docs: DataFrame, min_margin: float = MIN_MARGIN, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with ``__li`` (struct of ``lang_pred, score, rejected, held_out``), learnt from the rows not held out."""
    short_batches(docs.sparkSession)
    dictionaries = fit(docs.where(~held_out(id_col)), id_col, text_col, lang_col)
    found = docs.withColumn("__li", identify(F.col(text_col), dictionaries, min_margin))
    return found.withColumn("__li", F.struct("__li.lang_pred", "__li.score", "__li.rejected", held_out(id_col).alias("held_out")))

"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

A sentence's chance is logistic in its words; a document's is the noisy-or of its sentences, 1 - prod(1 - p). Weights are
trained from document labels alone and then tell which sentences offend. A word counts as itself and as its first four and
six letters, so that endings don't hide a stem; features are hashed to ``BUCKETS``.

``fit`` learns from a bounded sample of labelled rows: of at most ``SAMPLE_DOCS`` of each label, by the hash of their id, those
whose whole texts fit into ``SAMPLE_BYTES`` a label. Executors turn the sample to feature numbers; only these reach the
driver, whose work is bounded by the sample. Of the features that ``MIN_DOCS`` sampled documents have, the ``FEATURES``
that tell the labels apart best are kept. Toxic documents are few, so the noisy-or's chances are low for all but the plainest;
``fit`` therefore scores each third of the sample by a model of the others, takes the chance that tells the labels apart best
there, and shifts log odds so that it becomes 0.5. Scoring takes whole texts, row by row, without a shuffle.

Defined cases: a null or empty text has no sentence and the score 0; labels other than 0 and 1, null labels and labels
without a document are left out; with no labelled rows, or only one label, all scores are 0. A label row that is repeated
counts once, and of labels that disagree 1 counts; of documents that share an id the longest teaches. Null ids teach nothing
and are scored like others.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import least_hashed, short_batches, stored, whole, within

SAMPLE_DOCS, SAMPLE_BYTES = 5000, 8 << 20
BUCKETS, FEATURES, MIN_DOCS = 1 << 20, 20_000, 6
ROUNDS, RATE, DECAY, BIAS = 200, 0.1, 2e-4, -6.0
#: Parts of the sample that are scored by a model of the others, and how many missed toxic shares a false one weighs.
FOLDS, FALSE_WEIGHT = 3, 2.0

_SENTENCE = re.compile(r"[.!?\n|]+")
_EDGES = " ,;:()[]{}\"'*&$#%<>/\\-_=+~`^@.!?|"
#: Words whose weights a worker keeps, and the characters of the longest of them.
CACHE_WORDS, CACHED_CHARS = 150_000, 64


def sentences(text: str) -> list[list[str]]:
    """A text's sentences as words in lower case."""
    return [words for s in _SENTENCE.split(text.lower()) if (words := s.split())]


def features(word: str) -> list[int]:
    word = word.strip(_EDGES)
    keys = {f"={word}", f"^{word[:4]}", f"^{word[:6]}"} if len(word) > 2 else set()
    return [xxhash.xxh32_intdigest(k) % BUCKETS for k in sorted(keys)]


class Model:
    """Feature numbers and their weights; scores sentences by a bounded cache of words."""

    _made: dict[bytes, "Model"] = {}

    def __init__(self, numbers: np.ndarray, weights: np.ndarray, bias: float, shift: float = 0.0):
        self.table = dict(zip(numbers.tolist(), weights.tolist()))
        self.bias, self.shift = bias, shift
        self.words: dict[str, float] = {}

    @classmethod
    def of(cls, numbers: np.ndarray, weights: np.ndarray, bias: float, shift: float) -> "Model":
        key = xxhash.xxh128_digest(numbers.tobytes() + weights.tobytes() + f"{bias} {shift}".encode())
        if key not in cls._made:
            cls._made = {key: cls(numbers, weights, bias, shift)}
        return cls._made[key]

    def weight(self, word: str) -> float:
        known = self.words.get(word)
        if known is None:
            known = sum(self.table.get(f, 0.0) for f in features(word))
            if len(word) <= CACHED_CHARS:
                if len(self.words) >= CACHE_WORDS:
                    self.words.clear()
                self.words[word] = known
        return known

    def odds(self, text: str | None) -> np.ndarray:
        """Log odds of each sentence."""
        weight = self.weight
        return np.array([self.bias + sum(map(weight, words)) for words in sentences(text or "")])

    def score(self, text: str | None) -> float:
        odds = self.odds(text)
        return float(_shifted(np.logaddexp(0, odds).sum(), self.shift)) if self.table and len(odds) else 0.0


def _shifted(total: np.ndarray | float, shift: float) -> np.ndarray:
    """The chance whose log odds are those of 1 - exp(-total), and ``shift`` more."""
    log_odds = total + np.log(-np.expm1(-np.maximum(total, 1e-300)))
    return 1 / (1 + np.exp(-np.clip(log_odds + shift, -700, 700)))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``toxic, ends, numbers`` of sampled documents: each sentence's end in the list of feature numbers."""
    marked = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    drawn = least_hashed(marked.withColumn("at", F.xxhash64("doc_id")), "toxic", "at", SAMPLE_DOCS)
    drawn = stored(drawn, "tx-drawn")  # 2 * SAMPLE_DOCS rows at most
    sizes = docs.select("doc_id", F.octet_length(whole()).alias("size")).join(F.broadcast(drawn), "doc_id").groupBy("toxic", "at", "doc_id").agg(F.max("size").alias("size"))
    fits = within(sizes.select("toxic", "size", "at", "doc_id").orderBy("toxic", "at").collect(), SAMPLE_BYTES)
    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.sparkSession.createDataFrame([(r["doc_id"], r["toxic"], r["at"]) for r in fits], f"doc_id {kind}, toxic int, at long")
    texts = docs.select("doc_id", whole().alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "toxic", "at").agg(F.max_by("text", F.struct(F.octet_length("text"), "text")).alias("text"))

    def numbered(batches):
        for batch in batches:
            ends, numbers, seen = [], [], {}
            for text in batch.column("text").to_pylist():
                found, own = [], []
                for words in sentences(text):
                    for word in words:
                        if word not in seen:
                            seen[word] = features(word)
                        found += seen[word]
                    own.append(len(found))
                ends.append(own)
                numbers.append(found)
            columns = [batch.column("toxic"), batch.column("at"), pa.array(ends, pa.list_(pa.int32())), pa.array(numbers, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "at", "ends", "numbers"])

    return texts.select("toxic", "at", "text").mapInArrow(numbered, "toxic int, at long, ends array<int>, numbers array<int>")


def train(toxic: np.ndarray, ends: list[np.ndarray], numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, float]:
    """Numbers, weights and bias by gradient steps on the noisy-or's log loss."""
    nothing = np.zeros(0, np.int64), np.zeros(0), BIAS
    if not (toxic == 1).any() or not (toxic == 0).any():
        return nothing
    seen = [np.bincount(np.concatenate([np.unique(n) for n, t in zip(numbers, toxic) if t == y] or [np.zeros(0, int)]).astype(np.int64), minlength=BUCKETS) for y in (0, 1)]
    share = [(s + 0.5) / ((toxic == y).sum() + 1.0) for y, s in enumerate(seen)]
    telling = np.abs(np.log(share[1] / share[0])) * np.sqrt(seen[0] + seen[1])
    telling[seen[0] + seen[1] < MIN_DOCS] = -1
    kept = np.sort(np.argsort(-telling, kind="stable")[:FEATURES])
    kept = kept[telling[kept] >= 0]
    place = np.full(BUCKETS, -1, np.int32)
    place[kept] = np.arange(len(kept))

    column, sentence, document, at = [], [], [], 0
    for d, (own, found) in enumerate(zip(ends, numbers)):
        where = place[np.asarray(found, np.int64)]
        column.append(where[where >= 0])
        sentence.append((np.searchsorted(own, np.arange(len(where)), side="right") + at)[where >= 0])
        document.append(np.full(len(own), d))
        at += len(own)
    column, sentence, document = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (column, sentence, document))
    weights, bias = np.zeros(len(kept)), BIAS
    step1, step2 = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for t in range(1, ROUNDS + 1):
        odds = bias + np.bincount(sentence, weights[column], at)
        total = np.bincount(document, np.logaddexp(0, odds), len(toxic))
        slope = np.where(toxic == 1, -1 / np.maximum(np.expm1(np.minimum(total, 50)), 1e-6), 1.0)
        inner = slope[document] / (1 + np.exp(-np.clip(odds, -700, 700)))
        gradient = np.append(np.bincount(column, inner[sentence], len(kept)), inner.sum()) / len(toxic)
        gradient[:-1] += DECAY * weights
        step1, step2 = 0.9 * step1 + 0.1 * gradient, 0.99 * step2 + 0.01 * gradient**2
        move = RATE * (step1 / (1 - 0.9**t)) / (np.sqrt(step2 / (1 - 0.99**t)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return kept.astype(np.int64), weights, float(bias)


def _totals(ends: list[np.ndarray], numbers: list[np.ndarray], numbers_kept: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """-ln(1 - noisy-or) of each document."""
    table = np.zeros(BUCKETS)
    table[numbers_kept] = weights
    out = []
    for own, found in zip(ends, numbers):
        sums = np.append(0.0, np.cumsum(table[found]))[np.append(0, own)]
        out.append(np.logaddexp(0, bias + np.diff(sums)).sum() if len(own) else 0.0)
    return np.array(out)


def calibrated(toxic: np.ndarray, ends: list[np.ndarray], numbers: list[np.ndarray]) -> float:
    """The shift of log odds that puts 0.5 where the labels are told apart best, by models that have not seen the documents."""
    totals = np.zeros(len(toxic))
    for fold in range(FOLDS):
        inside = np.arange(len(toxic)) % FOLDS == fold
        learnt = train(toxic[~inside], [e for e, i in zip(ends, inside) if not i], [n for n, i in zip(numbers, inside) if not i])
        totals[inside] = _totals([e for e, i in zip(ends, inside) if i], [n for n, i in zip(numbers, inside) if i], *learnt)
    order = np.argsort(-totals, kind="stable")
    caught = np.cumsum(toxic[order] == 1) / max(1, (toxic == 1).sum())
    false = np.cumsum(toxic[order] == 0) / max(1, (toxic == 0).sum())
    at = int(np.argmax(caught - FALSE_WEIGHT * false))
    total = np.maximum((totals[order[at]] + totals[order[min(at + 1, len(order) - 1)]]) / 2, 1e-12)
    return float(-(total + np.log(-np.expm1(-total))))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Feature numbers, weights, bias and shift from documents (doc_id, text) and labels (doc_id, toxic)."""
    short_batches(docs.sparkSession)
    rows = _sample(docs, labels).toArrow().combine_chunks().sort_by([("at", "ascending"), ("toxic", "ascending")]).combine_chunks()

    def lists(name):  # views of one array, without an object for each number
        column = rows.column(name).combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.int32()))
        values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
        return [values[a:b] for a, b in zip(offsets, offsets[1:])]

    toxic, ends, numbers = rows.column("toxic").to_numpy(), lists("ends"), lists("numbers")
    learnt = train(toxic, ends, numbers)
    return *learnt, calibrated(toxic, ends, numbers) if len(learnt[0]) else 0.0


def score(text: Column, model: tuple[np.ndarray, np.ndarray, float, float]) -> Column:
    """A text's chance of being toxic."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        made = Model.of(*model)
        return pd.Series([made.score(t) for t in texts], dtype=float)

    return scored(text)


def offending(text: Column, model: tuple[np.ndarray, np.ndarray, float, float], least: float = 0.5) -> Column:
    """The sentences (number from 0, words joined by spaces, chance) whose chance is at least ``least``."""

    @F.pandas_udf("array<struct<number:int,sentence:string,chance:double>>")
    def located(texts: pd.Series) -> pd.Series:
        made, out = Model.of(*model), []
        for text in texts:
            chances = 1 / (1 + np.exp(-made.odds(text)))
            words = sentences(text or "")
            out.append([{"number": int(i), "sentence": " ".join(words[i]), "chance": float(chances[i])} for i in np.flatnonzero(chances >= least)])
        return pd.Series(out)

    return located(text)


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0

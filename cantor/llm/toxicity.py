"""Toxicity by multiple-instance learning: sentences are instances, documents carry the labels.

A sentence's probability is logistic in its words; a document is toxic if any of its sentences is, so its
probability is the noisy-or of theirs. Training follows the gradient of the document likelihood through the
noisy-or, which tells which sentences offend although no sentence was labelled.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantor.llm.common import Scratch, portions

#: Bounds of the sample that the classifier is fitted on: documents, their characters, and words that it weighs.
MAX_TRAIN_DOCS = 8000
MAX_TRAIN_CHARS = 64_000_000
MAX_TRAIN_WORDS = 400
#: Lengths of the word beginnings that are features.
BEGINNINGS = (4, 5, 6, 7)
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
SCORED = "doc_id long, score double, n_sentences long, n_offending long, offending array<struct<start:long,end:long,p:double>>"


def sentences(text: str) -> list[tuple[int, int, set[str]]]:
    """(start, end, distinct lower-cased words) of each sentence that has words."""
    out = []
    for m in _SENTENCE.finditer(text):
        if words := set(_WORD.findall(m[0].lower())):
            out.append((m.start(), m.end(), words))
    return out


def features(word: str) -> list[str]:
    """The word itself, and its beginnings, by which inflected forms share what is learned."""
    return [word, *("^" + word[:k] for k in BEGINNINGS if len(word) > k)]


class _Memo(dict):
    """Values by word, computed once; starts anew when full, so its memory is bounded."""

    def __init__(self, f):
        self.f = f

    def __missing__(self, word: str):
        if len(self) > 200_000:
            self.clear()
        value = self[word] = self.f(word)
        return value


class NoisyOr:
    """weights by feature, and the bias that every sentence has."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self._words = _Memo(self._weigh)

    def __reduce__(self):
        return NoisyOr, (self.weights, self.bias)

    def _weigh(self, word: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(word))

    def score(self, text: str) -> tuple[float, int, list[tuple[int, int, float]]]:
        """The document's probability, its sentences, and the spans of those at 0.5 or more."""
        if not any(map(self._words.__getitem__, _WORD.findall(text.lower()))):
            n = sum(1 for m in _SENTENCE.finditer(text) if _WORD.search(m[0]))
            return float(-np.expm1(-n * np.log1p(np.exp(self.bias)))), n, []
        mass, spans, found = 0.0, [], sentences(text)
        for start, end, words in found:
            z = self.bias + sum(map(self._words.__getitem__, words))
            mass += float(np.logaddexp(0.0, z))
            if z >= 0:
                spans.append((start, end, round(float(1 / (1 + np.exp(-z))), 6)))
        return float(-np.expm1(-mass)), len(found), spans


def _surprise(a: np.ndarray, d: np.ndarray, share: float) -> np.ndarray:
    """Log of the bound on how often chance gives a feature of d documents a toxic ones (Chernoff)."""
    a, d = a.astype(float), d.astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        value = a * np.log(a / d / share) + np.where(a < d, (d - a) * np.log((1 - a / d) / (1 - share)), 0.0)
    return np.where((a > 2) & (a > d * share), value, 0.0)


def choose_features(texts: list[str], y: np.ndarray, most: int) -> list[str]:
    """Features that toxic documents have more often than chance explains.

    Counts go to hashed buckets first, so that memory doesn't grow with the vocabulary; only features of
    striking buckets are then counted by name. Of all features together, chance should pass a tenth of one.
    """
    size = 1 << 20
    buckets = _Memo(lambda w: [zlib.crc32(f.encode()) % size for f in features(w)])
    df, hits = np.zeros(size, np.int32), np.zeros(size, np.int32)
    for text, label in zip(texts, y, strict=True):
        own = np.unique(np.fromiter((b for w in set(_WORD.findall(text.lower())) for b in buckets[w]), np.int64))
        df[own] += 1
        hits[own] += int(label)
    share = float(y.mean())
    least = np.log(10 * max(1, int((df > 2).sum())))
    striking = _surprise(hits, df, share) >= least
    named, named_hits = Counter(), Counter()
    for text, label in zip(texts, y, strict=True):
        own = {f for w in set(_WORD.findall(text.lower())) if striking[buckets[w]].any() for f in features(w) if striking[zlib.crc32(f.encode()) % size]}
        named.update(own)
        if label:
            named_hits.update(own)
    names = sorted(named)
    worth = _surprise(np.array([named_hits[f] for f in names]), np.array([named[f] for f in names]), share) if names else np.zeros(0)
    chosen: dict[tuple, str] = {}
    for _, f in sorted((-g, f) for g, f in zip(worth, names, strict=True) if g >= least):
        # of a word and beginnings that stand in the same documents, one is enough: the longest
        key = (named[f], named_hits[f], f.lstrip("^")[:4])
        chosen[key] = max(chosen.get(key, ""), f, key=lambda x: len(x.lstrip("^")))
    return list(chosen.values())[:most]


def train(texts: list[str], labels: list[int], max_words: int = MAX_TRAIN_WORDS, steps: int = 300, rate: float = 0.2, decay: float = 2e-5) -> NoisyOr:
    """Fits the noisy-or to document labels (1 or 0); without both labels, nothing is toxic."""
    y = np.asarray(labels, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return NoisyOr({}, -9.0)
    vocabulary = choose_features(texts, y, max_words)
    number = {f: i for i, f in enumerate(vocabulary)}
    numbers = _Memo(lambda w: [number[f] for f in features(w) if f in number])
    n, lengths, rows, cols = len(y), [], [], []
    at = 0
    for text in texts:
        bag = sentences(text)
        lengths.append(len(bag))
        for _, _, words in bag:
            for w in words:
                for f in numbers[w]:
                    rows.append(at)
                    cols.append(f)
            at += 1
    rows, cols, doc_of = np.asarray(rows, np.int64), np.asarray(cols, np.int64), np.repeat(np.arange(n), lengths)
    w, b = np.zeros(len(vocabulary)), -5.0
    m = [np.zeros_like(w), 0.0]
    v = [np.zeros_like(w), 0.0]
    for step in range(1, steps + 1):
        z = b + np.bincount(rows, w[cols], len(doc_of))
        mass = np.bincount(doc_of, np.logaddexp(0, z), n)
        lead = y / np.maximum(np.expm1(np.minimum(mass, 700)), 1e-6) - (1 - y)
        slope = lead[doc_of] / (1 + np.exp(-z))
        grad = [np.bincount(cols, slope[rows], len(w)) / n - decay * w, slope.sum() / n]
        for k, g in enumerate(grad):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            move = rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
            if k == 0:
                w = w + move
            else:
                b = float(b + move)
    return NoisyOr({word: float(x) for word, x in zip(vocabulary, w, strict=True) if abs(x) > 0.1}, b)


def train_on(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN_DOCS, max_chars: int = MAX_TRAIN_CHARS) -> NoisyOr:
    """Fits on labelled documents in the order of a hash of their id, ``max_docs`` and ``max_chars`` at most.

    labels: doc_id, toxic. Rows without an id or label are left out; of several labels or texts of one id the
    highest counts. A document that would pass ``max_chars`` is left out whole.
    """
    chosen = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.coalesce(F.max("text"), F.lit("")).alias("text"), F.max("toxic").alias("toxic"))
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = scratch.save(rows, "sample")
    total, fitting = 0, []
    for doc_id, chars in sample.select("doc_id", F.length("text")).orderBy(F.xxhash64("doc_id"), "doc_id").collect():
        if total + chars <= max_chars:
            total += chars
            fitting.append((doc_id,))
    fitting = docs.sparkSession.createDataFrame(fitting, sample.select("doc_id").schema)
    rows = sample.join(F.broadcast(fitting), "doc_id").select("doc_id", "text", "toxic").toArrow()
    scratch.drop("")
    rows = sorted(zip(*(rows.column(c).to_pylist() for c in ("doc_id", "text", "toxic")), strict=True), key=lambda r: (r[0], r[1] or ""))
    return train([r[1] or "" for r in rows], [int(r[2]) for r in rows])


def score_documents(docs: DataFrame, model: NoisyOr) -> DataFrame:
    """Scores every whole text (null: empty, which has no sentence and scores 0): columns of SCORED.

    The model is bounded by MAX_TRAIN_WORDS words, so it travels with the tasks.
    """
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            found = [model.score(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int64()), pa.array([len(f[2]) for f in found], pa.int64()), pa.array([[{"start": a, "end": e, "p": p} for a, e, p in f[2]] for f in found], spans)],
                names=["doc_id", "score", "n_sentences", "n_offending", "offending"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCORED)

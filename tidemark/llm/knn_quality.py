"""Quality classifier: nearest-neighbour voting among labelled documents in a latent-semantic space.

Terms of a document: its words (A-Z lower-cased; the `max_words` that most of the sample's documents hold, two at least), the shapes of its words (runs of lower case, capitals, digits as one sign; other characters as they
are; a shape of over 16 signs counts as consecutive shapes of 16), pairs of neighbouring shapes, and how its words repeat (the word before again, a word seen before, a line seen
before). Weights are log-scaled shares times inverse document frequencies; a truncated singular value decomposition of
the labelled sample's term matrix spans the space. The sample is bounded: the first `max_labelled` rows by hash order of
those that `learnable` allows, which bounds all that is broadcast (documents x dimensions, terms x dimensions).

A document's score: of its `k` labelled neighbours with the highest cosine (exact, by blocked matrix products against all
of them), the share of label 1, each weighted by its similarity to the power of `sharpness`. Ids, languages and sources
are never looked at.

Defined results: very long texts are scored whole (the sample to learn from leaves out those of over `max_chars`); texts without words, null ones included, and texts that share no direction with any neighbour score
the sample's share of label 1; with no labels the score is 0.5; ties of similarity go to the earlier row in hash order;
repeated rows score alike; labels for absent documents and null labels are not learnt from; empty tables give empty
results; extra columns are left out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import LOWER_ASCII, encode, fields, shape, slices

_SHAPE = bytes(97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))
#: What a term that is a word starts with.
WORD = b"\n="
_RUNS = re.compile(rb"(.)\1+", re.S)


class Terms:
    """Counts the terms of texts; remembers the shapes of a bounded number of words of at most 64 bytes."""

    def __init__(self, remember: int = 100_000, words: frozenset[bytes] | None = None):
        self.words = words  # those that count as terms; all of up to 64 bytes where they are not given
        self.shapes: dict[bytes, list[bytes]] = {}
        self.remember = remember

    def shape(self, word: bytes) -> list[bytes]:
        """The whole word's shape, in stretches of 16 signs."""
        if (s := self.shapes.get(word)) is None:
            whole = _RUNS.sub(rb"\1", word.translate(_SHAPE))
            s = [whole[i : i + 16] for i in range(0, len(whole), 16)]
            if len(word) > 64:
                return s
            if len(self.shapes) >= self.remember:
                self.shapes.clear()
            self.shapes[word] = s
        return s

    def weights(self, text: str | None) -> dict[bytes, float]:
        data = encode(text)
        words = data.split()
        if not words:
            return {}
        n = len(words)
        shapes = [s for stretches in map(self.shape, words) for s in stretches]
        counts = Counter(shapes)
        pairs = Counter(zip(shapes, shapes[1:], strict=False))
        out = {s: math.log1p(100 * c / len(shapes)) for s, c in counts.items()}
        out |= {a + b" " + b: math.log1p(100 * c / len(shapes)) for (a, b), c in pairs.items()}
        lines = data.split(b"\n")
        same = sum(a == b for a, b in zip(words, words[1:], strict=False))
        three = n - 2 - len(set(zip(words, words[1:], words[2:], strict=False))) if n > 2 else 0
        seen = len(lines) - len(set(lines))
        lower = data.translate(LOWER_ASCII).split()
        own = Counter(w for w in lower if w in self.words) if self.words is not None else Counter(w for w in lower if len(w) <= 64)
        out |= {WORD + w: 0.5 * math.log1p(100 * c / n) for w, c in own.items()}
        for name, share in ((b"\nagain", same / n), (b"\nthree", three / n), (b"\nline", seen / len(lines))):
            for level in (0.02, 0.1, 0.3, 0.6):
                if share > level:
                    out[name + str(level).encode()] = 3.0
        return out


@dataclass
class Space:
    """Labelled documents as unit vectors, their labels, and how to get there from terms."""

    terms: dict[bytes, int]
    to_space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, rows: list[dict[bytes, float]]) -> np.ndarray:
        out = np.zeros((len(rows), self.to_space.shape[1]), np.float32)
        for i, row in enumerate(rows):
            at = [(j, w) for t, w in row.items() if (j := self.terms.get(t)) is not None]
            if at:
                own = np.array([w for _, w in at], np.float32) @ self.to_space[[j for j, _ in at]]
                out[i] = own / max(1e-9, float(np.linalg.norm(own)))
        return out

    def score(self, rows: list[dict[bytes, float]], k: int, sharpness: float, block: int = 256) -> np.ndarray:
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        out = np.full(len(rows), prior)
        if not len(self.labels):
            return out
        k = min(k, len(self.labels))
        for a in range(0, len(rows), block):
            # nine decimals: what a product's place in its block does to it is far below, so equal texts score alike
            cosines = np.round(self.project(rows[a : a + block]).astype(float) @ self.vectors.T.astype(float), 9)
            least = -np.partition(-cosines, k - 1, axis=1)[:, k - 1 : k]
            ties = cosines == least
            chosen = (cosines > least) | (ties & (np.cumsum(ties, 1) <= k - (cosines > least).sum(1, keepdims=True)))
            near = np.nonzero(chosen)[1].reshape(-1, k)
            close = np.take_along_axis(cosines, near, 1)
            weight = np.maximum(close, 0) ** sharpness
            total = weight.sum(1)
            out[a : a + block] = np.where(total > 1e-6, (weight * self.labels[near]).sum(1) / np.maximum(total, 1e-6), prior)
        return np.clip(out, 0, 1)


def train(docs: DataFrame, labels: DataFrame, learnable: Column | None = None, doc_id: str = "doc_id", text: str = "text", quality: str = "quality", max_labelled: int = 4000, max_chars: int = 40_000, dims: int = 48, max_terms: int = 6000, max_words: int = 2000) -> Space:
    """Fit on the first `max_labelled` allowed labelled ids by hash order, documents of at most `max_chars` characters; of texts of one id the least."""
    known = labels.where(F.col(quality).isin(0, 1) & F.col(doc_id).isNotNull())
    if learnable is not None:
        known = known.where(learnable)
    chosen = known.select(F.col(doc_id).alias("id"), F.col(quality).cast("int").alias("q")).groupBy("id").agg(F.min("q").alias("q")).orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("t")).join(F.broadcast(chosen), "id")
    rows = rows.groupBy("id").agg(F.min("t").alias("t"), F.min("q").alias("q")).where(F.length("t") <= max_chars)  # one text an id

    frame = rows.select(F.xxhash64("id").alias("h"), "t", "q")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for x in batch.column(1):
                yield pa.RecordBatch.from_arrays([pa.array({w for w in encode(x.as_py()).translate(LOWER_ASCII).split() if len(w) <= 64}, pa.binary())], names=["word"])

    often = frame.mapInArrow(words, shape(("word", "binary"))).groupBy("word").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "word").limit(max_words)
    known_words = frozenset(bytes(r.word) for r in often.collect())

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Terms(words=known_words)
        for batch in slices(batches):
            found = [reader.weights(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array([list(r) for r in found], pa.list_(pa.binary())), pa.array([list(r.values()) for r in found], pa.list_(pa.float32())), batch.column(2), batch.column(0)], names=["terms", "weights", "q", "h"])

    taught = sorted(frame.mapInArrow(terms, "terms array<binary>, weights array<float>, q int, h bigint").collect(), key=lambda r: (r.h, r.q, r.terms))
    df = Counter(bytes(t) for r in taught for t in r.terms)
    shapes = sorted((t for t, n in df.items() if n > 1 and not t.startswith(WORD)), key=lambda t: (-df[t], t))[:max_terms]
    kept = shapes + sorted(t for t in df if t.startswith(WORD))
    number = {t: i for i, t in enumerate(kept)}
    idf = np.array([math.log((1 + len(taught)) / (0.5 + df[t])) for t in kept], np.float32)
    full = [(i, number[bytes(t)], w) for i, r in enumerate(taught) for t, w in zip(r.terms, r.weights, strict=True) if bytes(t) in number]
    labelled = np.array([r.q for r in taught], np.float32)
    if not full:
        return Space({}, np.zeros((0, 1), np.float32), np.zeros((len(taught), 1), np.float32), labelled)
    row, col, value = (np.array(x) for x in zip(*full, strict=True))
    matrix = np.zeros((len(taught), len(kept)), np.float32)
    matrix[row, col] = value * idf[col]
    # truncated decomposition by subspace iteration from a fixed start
    size = min(dims, *matrix.shape)
    basis = np.random.default_rng(7).standard_normal((len(kept), min(size + 10, len(kept)))).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    directions = (basis @ right.T)[:, :size]
    vectors = matrix @ directions
    vectors /= np.maximum(1e-9, np.linalg.norm(vectors, axis=1, keepdims=True))
    return Space(number, (idf[:, None] * directions).astype(np.float32), vectors.astype(np.float32), labelled)


def classify(docs: DataFrame, space: Space, doc_id: str = "doc_id", text: str = "text", k: int = 15, sharpness: float = 8.0, threshold: float = 0.3) -> DataFrame:
    """One row per document: its id, score (likelihood of label 1), predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Terms(words=frozenset(t[len(WORD) :] for t in shared.value.terms if t.startswith(WORD)))
        for part in slices(batches):
            score = shared.value.score([reader.weights(x.as_py()) for x in part.column(1)], k, sharpness)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], names=["id", "score", "predicted"])

    frame = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("t"))
    return frame.mapInArrow(run, shape(("id", docs.schema[doc_id].dataType), *fields("score double, predicted int"))).withColumnRenamed("id", doc_id)

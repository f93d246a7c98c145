"""Quality rules: a linear-chain conditional random field labels lines, Viterbi decoding finds content and boilerplate.

A line is a \\n-split piece of a text that has a word `[^\\x20\\x09-\\x0D]+`; each gets a few shares (symbols,
capitals, repeated words, ...) as features. The field has two labels, content and boilerplate. A document is
kept if it passes the base rules and at least `min_share` of its words stand in content lines.

Training: labels exist for documents only, so a logistic model of the lines, taught with their document's
label, first marks the boilerplate lines of the poor documents (all lines of good ones are content); the
field is then fitted to those marks by its exact likelihood (forward-backward). The sample is bounded:
`max_docs` labelled documents by hash order, of at most `max_lines` lines each.

Defined results: very long texts are judged whole, line by line; null, empty or word-less texts have no words and fail the base rules; a document is judged
by itself, so ties, repeated rows and row order change nothing; labels that are null or for absent documents
are not learnt from; with no or one-sided labels a fixed field (symbols and repetition are boilerplate) stands
in; empty tables give empty results; extra columns pass through `keep_content` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import encode, fields, from_row, in_row, shape, slices

SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\v\f\r"
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
FEATURES = ("bias", "symbols", "bars", "shouts", "capitals", "digits", "repeated", "doubled", "seen_before", "short", "open_end")
MIN_WORDS, MAX_REPEAT = 50, 50


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    data = encode(text)
    words = data.split()
    n = len(words)
    if not n:
        return 0, 0, len(data) - len(data.translate(None, SYMBOLS)), 0, 0
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    lines = [x for x in data.split(b"\n") if x.split(None, 1)]
    repeated = 0
    if n > 2:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) < len(windows):
            first: dict[tuple, int] = {}
            marked = bytearray(n)
            for i, w in enumerate(windows):
                if (j := first.setdefault(w, i)) != i:
                    marked[i : i + 3] = marked[j : j + 3] = b"\1\1\1"
            repeated = marked.count(1)
    return n, chars, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated


def line_features(text: str | None) -> tuple[list[tuple[float, ...]], list[int], list[int]]:
    """Features, words and numbers (from 0, among all \\n-split lines) of each line with a word."""
    rows, sizes, numbers = [], [], []
    seen: set[bytes] = set()
    for number, line in enumerate(encode(text).split(b"\n")):
        words = line.split()
        if not words:
            continue
        n, chars = len(words), len(line)
        share = lambda drop, of=chars, line=line: (of - len(line.translate(None, drop))) / of
        rows.append((1.0, min(1.0, 4 * share(SYMBOLS)), min(1.0, 10 * share(b"|")), min(1.0, 4 * share(b"!")), share(_UPPER), share(_DIGITS), 1 - len(set(words)) / n, sum(map(eq, words, words[1:])) / n, float(line in seen), float(n < 4), float(words[-1][-1:] not in b".!?:;,\"'")))
        seen.add(line)
        sizes.append(n)
        numbers.append(number)
    return rows, sizes, numbers


@dataclass
class LineCrf:
    """Weights of the two labels (0 content, 1 boilerplate): emission per feature, transition, start."""

    emission: np.ndarray = field(default_factory=lambda: np.stack([np.zeros(len(FEATURES)), np.array([-2.0, 6, 6, 6, 2, 1, 4, 6, 2, 0, 0])]))
    transition: np.ndarray = field(default_factory=lambda: np.array([[0.5, -0.5], [-0.5, 0.5]]))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))

    def viterbi(self, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Labels of the lines of many documents; `lengths`: lines of each. Documents advance together, longest first; ties go to content."""
        score = features @ self.emission.T
        out = np.zeros(len(features), np.int8)
        order = np.argsort(-lengths, kind="stable")
        size, at = lengths[order], (np.cumsum(lengths) - lengths)[order]
        back = np.zeros((len(features), 2), np.int8)
        best = np.zeros((len(lengths), 2))
        steps = int(size[0]) if len(size) else 0
        active = np.searchsorted(-size, -np.arange(steps), side="left")
        for t in range(steps):
            a = active[t]
            i = at[:a] + t
            if t:
                one, two = best[:a, :1] + self.transition[0], best[:a, 1:] + self.transition[1]
                back[i] = two > one
                best[:a] = np.maximum(one, two) + score[i]
            else:
                best[:a] = self.start + score[i]
        state = (best[:, 1] > best[:, 0]).astype(np.int8)
        for t in range(steps - 1, -1, -1):
            a = active[t]
            i = at[:a] + t
            out[i] = state[:a]
            state[:a] = back[i, state[:a]]
        return out

    def gradients(self, features: np.ndarray, at: np.ndarray, mask: np.ndarray, gold: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Log-likelihood of padded sequences (at: line numbers, docs x steps) and its gradients, by forward-backward."""
        score = (features @ self.emission.T)[at]
        n, steps, _ = score.shape
        forward, backward = np.zeros((n, steps, 2)), np.zeros((n, steps, 2))
        forward[:, 0] = self.start + score[:, 0]
        for t in range(1, steps):
            new = np.logaddexp(forward[:, t - 1, :1] + self.transition[0], forward[:, t - 1, 1:] + self.transition[1]) + score[:, t]
            forward[:, t] = np.where(mask[:, t, None], new, forward[:, t - 1])
        for t in range(steps - 2, -1, -1):
            ahead = backward[:, t + 1] + score[:, t + 1]
            new = np.logaddexp(self.transition[:, 0] + ahead[:, :1], self.transition[:, 1] + ahead[:, 1:])
            backward[:, t] = np.where(mask[:, t + 1, None], new, backward[:, t + 1])
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        node = np.exp(forward + backward - total[:, None, None]) * mask[..., None]
        true = np.eye(2)[gold[at]] * mask[..., None]
        error = true - node
        d_emission = error.reshape(-1, 2).T @ features[at].reshape(-1, features.shape[1])
        pair = mask[:, 1:]
        edge = np.exp(forward[:, :-1, :, None] + self.transition + (score + backward)[:, 1:, None, :] - total[:, None, None, None]) * pair[..., None, None]
        d_transition = (true[:, :-1, :, None] * true[:, 1:, None, :] - edge).sum((0, 1))
        value = (score * true).sum() + (self.transition * (true[:, :-1, :, None] * true[:, 1:, None, :]).sum((0, 1))).sum() + (self.start * true[:, 0]).sum() - total.sum()
        return float(value), [d_emission, d_transition, error[:, 0].sum(0)]


def fit(sequences: list[tuple[np.ndarray, int]], rounds: int = 60) -> LineCrf:
    """The field learnt from (line features, quality 0 or 1 of the document)."""
    sequences = sorted((s for s in sequences if len(s[0])), key=lambda s: len(s[0]))
    if len({q for _, q in sequences}) < 2:
        return LineCrf()
    features = np.concatenate([f for f, _ in sequences])
    lengths = np.array([len(f) for f, _ in sequences])
    poor = np.repeat([1 - q for _, q in sequences], lengths).astype(float)
    weight = np.where(poor > 0, 1.0, poor.sum() / max(1.0, (1 - poor).sum()))
    w = np.zeros(features.shape[1])
    for _ in range(400):
        p = 1 / (1 + np.exp(-features @ w))
        w += 4 * (features.T @ (weight * (poor - p)) / weight.sum() - 1e-4 * w)
    gold = ((poor > 0) & (features @ w > 0)).astype(int)
    model = LineCrf(emission=np.zeros((2, features.shape[1])), transition=np.zeros((2, 2)))
    first = np.cumsum(lengths) - lengths
    blocks = []
    for a in range(0, len(lengths), 256):
        size = lengths[a : a + 256]
        at = first[a : a + 256, None] + np.minimum(np.arange(size.max()), size[:, None] - 1)
        blocks.append((at, np.arange(size.max()) < size[:, None]))
    params = [model.emission, model.transition, model.start]
    seen, slow = [np.zeros_like(p) for p in params], 0.3
    for _ in range(rounds):
        sums = [np.zeros_like(p) for p in params]
        for at, mask in blocks:
            for s, g in zip(sums, model.gradients(features, at, mask, gold)[1], strict=True):
                s += g / len(features)
        for p, s, g in zip(params, seen, sums, strict=True):
            g -= 1e-4 * p
            s += g * g
            p += slow * g / (np.sqrt(s) + 1e-9)
    return model


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality", max_docs: int = 2000, max_lines: int = 200) -> LineCrf:
    """Fit on a bounded sample: the first `max_docs` labelled ids by hash, documents of at most `max_lines` lines; of texts of one id the least."""
    chosen = labels.where(F.col(quality).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), F.col(quality).cast("int").alias("q")).groupBy("id").agg(F.min("q").alias("q")).orderBy(F.xxhash64("id"), "id").limit(max_docs)
    small = F.length(F.regexp_replace("t", "[^\n]", "")) < max_lines
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("t")).join(F.broadcast(chosen), "id")
    rows = rows.groupBy("id").agg(F.min("t").alias("t"), F.min("q").alias("q")).where(small)  # one text an id

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            flat = []
            for value in batch.column(0):
                rows, _, _ = line_features(value.as_py())
                flat.append([x for row in rows for x in row])
            yield pa.RecordBatch.from_arrays([pa.array(flat, pa.list_(pa.float32())), batch.column(1)], names=["f", "q"])

    taught = rows.select("t", "q").mapInArrow(sequences, "f array<float>, q int").collect()
    return fit(sorted(((np.array(r.f, float).reshape(-1, len(FEATURES)), r.q) for r in taught), key=lambda s: (len(s[0]), s[1], s[0].tobytes())))


_VERDICT = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, content_words bigint, content_share double"


def _judged(frame: DataFrame, model: LineCrf, min_share: float) -> DataFrame:
    """frame: (row struct, t text) -> (row, verdict columns)."""
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):  # keeps the lines in hand few
            counts, rows, sizes, lengths = [], [], [], []
            for value in batch.column(1):
                text = value.as_py()
                counts.append(base_counts(text))
                more, words, _ = line_features(text)
                rows += more
                sizes += words
                lengths.append(len(more))
            labels = shared.value.viterbi(np.array(rows, float).reshape(-1, len(FEATURES)), np.array(lengths, np.int64))
            content = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64) * (labels == 0))))
            ends = np.cumsum(lengths)
            inside = content[ends] - content[ends - lengths]
            n, chars, symbols, dup, repeat = np.array(counts, np.int64).reshape(-1, 5).T
            failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT * n)
            share = inside / np.maximum(n, 1)
            cols = (n, chars, symbols, dup, repeat, failed, ~failed & (share >= min_share), inside, share)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, cols)], names=["row", *(x.split()[0] for x in _VERDICT.split(", "))])

    return frame.mapInArrow(judge, shape(("row", frame.schema["row"].dataType), *fields(_VERDICT)))


def judge(docs: DataFrame, model: LineCrf, doc_id: str = "doc_id", text: str = "text", min_share: float = 0.7) -> DataFrame:
    """One row per document: base counts, base_failed, kept, words in content lines and their share."""
    out = _judged(docs.select(F.struct(F.col(doc_id).alias("id")).alias("row"), F.col(text).cast("string").alias("t")), model, min_share)
    return out.select(F.col("row.id").alias(doc_id), *(x.split()[0] for x in _VERDICT.split(", ")))


def keep_content(docs: DataFrame, model: LineCrf, text: str = "text", min_share: float = 0.7) -> DataFrame:
    """The documents that pass the base rules and the field's verdict, with all their columns."""
    return _judged(docs.select(in_row(docs), F.col(text).cast("string").alias("t")), model, min_share).where("kept").select(*from_row(docs.columns))


def label_lines(docs: DataFrame, model: LineCrf, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line with a word: doc_id, line (number from 0), n_words, boilerplate."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    frame = docs.select(F.struct(F.col(doc_id).alias("id")).alias("row"), F.col(text).cast("string").alias("t"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, value in enumerate(batch.column(1)):
                rows, sizes, numbers = line_features(value.as_py())
                if rows:
                    marks = shared.value.viterbi(np.array(rows), np.array([len(rows)]))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i] * len(rows))), pa.array(numbers, pa.int64()), pa.array(sizes, pa.int64()), pa.array(marks == 1)], names=["row", "line", "n_words", "boilerplate"])

    out = frame.mapInArrow(label, shape(("row", frame.schema["row"].dataType), *fields("line bigint, n_words bigint, boilerplate boolean")))
    return out.select(F.col("row.id").alias(doc_id), "line", "n_words", "boilerplate")

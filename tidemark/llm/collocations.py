"""Phrase collocation mining by SETM: relations of phrase occurrences, joined, counted and semi-joined length by length.

R1 holds the occurrences of words: piece, position, word, in text order. Rk is Rk-1 joined with itself by piece and adjacent position:
two phrases of k - 1 words that overlap in all but their ends are one of k words. Occurrences of a phrase are counted;
Rk is semi-joined with the phrases counted at least `least` times before it is joined on.

A row of a persisted relation is a *block*: the occurrences of some megabytes of texts of one language, sorted, in columns
of packed numbers. A place is the step from the occurrence before it: 1 if it is the next position of the same piece.
A block tells each of its distinct phrases once, with its own count (aggregated before the shuffle), so that
phrases, however frequent, are dealt evenly: by a hash of the phrase to buckets, where they are counted up and frequent ones get numbers. The
semi-join goes the same way back: a bucket tells each block which of its phrases are frequent, and their numbers. In a
block the join is a merge of neighbours. Occurrences are shuffled once a length, packed; texts never.

Memory is by the block and the bucket, whatever the tables' size: rows reach Python a few at a time, are written in row groups of their
own size, and buckets are as many as the phrases told ask for. A block meets what buckets tell it in a sorted stream.

Words are told apart by 128 bits of two fingerprints and their language, longer phrases exactly, by the numbers of their two parts.

Scores are made of decimals of 38 digits: exact as long as an n-gram occurs less than 10^15 times.

Defined results: null and empty texts have no words; a null lang is `und`; very long texts are one block each, with all their pieces; ties of
cuts go to the smaller first part, of scores to the greater count and then to the lesser phrase in UTF-8 byte order;
repeated rows count each time; empty tables give empty results; extra columns are not read, whatever they are called.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.segments import first_rows
from ._common import LARGE_ROWS, LOWER_ASCII, by_batches, discard, encode, give_back, packed, parallelism, shape, slices, unpacked, written
from .hashing import mix, prints

_U = np.uint64
#: Bytes of text in a block.
BLOCK = 5 << 20
#: Phrases told to a bucket, on average at most.
BUCKET = 1 << 20
#: Bytes of an Arrow batch on its way to Python.
BATCH = 2 << 20
#: 2: ends a piece, 1: ends a word.
_KIND = np.zeros(256, np.int8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
#: A distinct phrase of a block on its way to its bucket: its two parts (of a word: fingerprints), count, number in the block; and back.
_TOLD, _BACK = (_U, _U, np.uint32, np.uint32), (np.uint32, np.int64)
#: Numbers of frequent phrases: the bucket's, then one of its own.
_SHIFT = 40


_RELATION = shape(("block", "binary"), ("lang", "string"), ("n", "bigint"), ("distinct", "bigint"), ("step", "binary"), ("phrase", "binary"), ("own", "binary"), ("spelt", "array<string>"))


def _relation(block: bytes, lang: str, step: np.ndarray, phrase: np.ndarray, a: np.ndarray, b: np.ndarray, count: np.ndarray, spelt: list[bytes] | None = None) -> pa.RecordBatch:
    """One block: steps and phrases (numbers in the block) of the occurrences; the block's distinct phrases, frequent ones first."""
    order = np.argsort(-count, kind="stable")
    number = np.empty(len(order), np.uint32)
    number[order] = np.arange(len(order), dtype=np.uint32)
    own = packed(a[order], b[order], count[order].astype(np.uint32))
    words = None if spelt is None else [spelt[i].decode("utf-8", "replace") for i in order.tolist()]
    columns = [[block], [lang], [len(step)], [len(order)], [packed(step)], [packed(number[phrase])], [own], [words]]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.string())), strict=True)], names=_RELATION.names)


def _words(lang: str, texts: list[bytes]) -> pa.RecordBatch | None:
    """The block of R1 of some texts of a language."""
    text = b"\n".join([*texts, b""]).translate(LOWER_ASCII)
    data = np.frombuffer(text, np.uint8)
    kind = _KIND[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], kind > 0)).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return None
    piece = np.searchsorted(np.flatnonzero(kind == 2), start)
    step = np.append(2, 1 + (np.diff(piece) > 0)).astype(np.uint8)
    salt = _U(int.from_bytes(encode(lang)[:8].ljust(8, b"\0"), "little")) ^ mix(np.array([sum(b * 257**i for i, b in enumerate(encode(lang))) & (2**64 - 1)], _U))[0]
    a, b = (mix(prints(data, start, end, second) ^ salt) for second in (False, True))
    order = np.lexsort((b, a))
    new = np.append(True, (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0))
    phrase = np.empty(len(order), np.int64)
    phrase[order] = np.cumsum(new) - 1
    first = order[new]
    count = np.bincount(phrase)
    spelt = [text[s:e] for s, e in zip(start[first].tolist(), end[first].tolist(), strict=True)]
    return _relation(uuid.uuid4().bytes, lang, step, phrase, a[first], b[first], count, spelt)


def occurrences(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """R1 of the documents."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0

        def blocks() -> Iterator[pa.RecordBatch]:
            for own, texts in held.items():
                if (made := _words(own, texts)) is not None:
                    yield made

        for part in slices(batches, 64):
            for own, t in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                data = encode(t.as_py())
                if size and size + len(data) > BLOCK:
                    yield from blocks()
                    held, size = {}, 0
                held.setdefault(own, []).append(data)
                size += len(data) + 1
        yield from blocks()

    frame = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").cast("string").alias("t"))
    return frame.mapInArrow(read, _RELATION)


_COUNTED = shape(("block", "binary"), ("back", "binary"), ("id", "array<bigint>"), ("a", "array<bigint>"), ("b", "array<bigint>"), ("f", "array<bigint>"), ("lang", "string"), ("spelt", "array<string>"))


def counted(relation: DataFrame, least: int) -> DataFrame:
    """Group-count of a relation, a bucket of phrases at a time: rows for blocks (back: which of their phrases are frequent, and their
    numbers), and rows for the bucket's frequent phrases of a language (id, a and b, f; of words, what is spelt)."""
    buckets = max(parallelism(relation.sparkSession), -(-(relation.agg(F.sum("distinct")).first()[0] or 0) // BUCKET))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            for row in part.to_pylist():
                a, b, count = unpacked(row["own"], _U, _U, np.uint32)
                to = (mix(a ^ mix(b, 3), 11) % _U(buckets)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                ends = np.searchsorted(to[order], np.arange(buckets + 1)).tolist()
                spelt = None if row["spelt"] is None else np.array(row["spelt"], object)
                made = [(k, order[ends[k] : ends[k + 1]]) for k in range(buckets) if ends[k + 1] > ends[k]]
                told = [packed(a[own], b[own], count[own], own.astype(np.uint32)) for _, own in made]
                words = [None if spelt is None else spelt[own].tolist() for _, own in made]
                n = len(made)
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in made], pa.int64()), pa.array([row["block"]] * n, pa.binary()), pa.array([row["lang"]] * n, pa.string()), pa.array(told, pa.binary()), pa.array(words, pa.list_(pa.string()))], names=["bucket", "block", "lang", "told", "spelt"])

    def count(table: pa.Table) -> pa.Table:
        told = table.column("told")
        sizes = [len(x.as_buffer()) // sum(np.dtype(k).itemsize for k in _TOLD) for x in told]
        ends = np.cumsum(sizes)
        a, b, n, own = columns = [np.empty(ends[-1], k) for k in _TOLD]
        for x, hi, size in zip(told, ends.tolist(), sizes, strict=True):
            for column, part in zip(columns, unpacked(x.as_buffer(), *_TOLD), strict=True):
                column[hi - size : hi] = part
        order = np.lexsort((b, a))
        new = np.append(True, (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0))
        first = np.flatnonzero(new)
        total = np.add.reduceat(n[order].astype(np.int64), first)
        often = np.flatnonzero(total >= least)
        bucket = table.column("bucket")[0].as_py()
        id_of = np.full(len(first), -1, np.int64)
        id_of[often] = (bucket << _SHIFT) + np.arange(len(often))
        mine = np.empty(len(order), np.int64)
        mine[order] = id_of[np.cumsum(new) - 1]
        backs, blocks = [], []
        for block, hi, size in zip(table.column("block").to_pylist(), ends.tolist(), sizes, strict=True):
            kept = mine[hi - size : hi]
            if (kept >= 0).any():
                blocks.append(block)
                backs.append(packed(own[hi - size : hi][kept >= 0], kept[kept >= 0]))
        at = order[first[often]]  # an occurrence in some block of each frequent phrase
        part = np.searchsorted(ends, at, side="right")
        langs = np.array(table.column("lang").to_pylist(), object)[part]
        spelt = table.column("spelt")
        words = None
        if spelt.null_count == 0:
            flat = pa.concat_arrays([c.flatten() for c in spelt.chunks])
            words = np.array(flat.take(pa.array(at)).to_pylist(), object)
        rows = [(block, back, None, None, None, None, None, None) for block, back in zip(blocks, backs, strict=True)]
        for lang in sorted(set(langs)):
            s = np.flatnonzero(langs == lang)
            rows.append((None, None, id_of[often[s]], a[at[s]].view(np.int64), b[at[s]].view(np.int64), total[often[s]], lang, None if words is None else words[s].tolist()))
        del a, b, n, own, order, mine, columns, column, part
        give_back()
        kinds = (pa.binary(), pa.binary(), *[pa.list_(pa.int64())] * 4, pa.string(), pa.list_(pa.string()))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * len(kinds), kinds, strict=True)], names=_COUNTED.names)

    source = relation.select("block", "lang", "own", "spelt")
    dealt = source.mapInArrow(deal, shape(("bucket", "bigint"), ("block", "binary"), ("lang", "string"), ("told", "binary"), ("spelt", "array<string>")))
    return dealt.groupBy("bucket").applyInArrow(count, _COUNTED)


def longer(relation: DataFrame, told: DataFrame) -> DataFrame:
    """The relation semi-joined with its frequent phrases, and joined with itself by piece and adjacent position."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backs, of = [], None
        for part in slices(batches, 1):
            block, back, lang, step, phrase = (part.column(c)[0].as_py() for c in range(5))
            if block != of:
                backs, of = [], block
            if back is not None:
                backs.append(back)
                continue
            if not backs:
                continue
            (step,), (phrase,) = unpacked(step, np.uint8), unpacked(phrase, np.uint32)
            own, ids = (np.concatenate(c) for c in zip(*(unpacked(x, *_BACK) for x in backs), strict=True))
            number = np.full(int(phrase.max()) + 1, -1, np.int64)
            number[own] = np.arange(len(own))
            at, kept = np.cumsum(step.astype(np.int64)), number[phrase]
            often = np.flatnonzero(kept >= 0)
            at, kept = at[often], kept[often]
            next_ = np.flatnonzero(np.diff(at) == 1)
            if not len(next_):
                continue
            pair = (kept[next_].astype(_U) << _U(32)) | kept[next_ + 1].astype(_U)
            distinct, place, count = np.unique(pair, return_inverse=True, return_counts=True)
            a, b = ids[(distinct >> _U(32)).astype(np.int64)], ids[(distinct & _U(0xFFFFFFFF)).astype(np.int64)]
            step = np.append(2, np.where(np.diff(at[next_]) == 1, 1, 2)).astype(np.uint8)
            yield _relation(block, lang, step, place, a.view(_U), b.view(_U), count)

    backs = told.where("block is not null").select("block", "back", *(F.lit(None).cast(k).alias(c) for c, k in (("lang", "string"), ("step", "binary"), ("phrase", "binary"))))
    rows = backs.unionByName(relation.select("block", F.lit(None).cast("binary").alias("back"), "lang", "step", "phrase"))
    return rows.repartition("block").sortWithinPartitions("block", F.col("lang").asc_nulls_first()).mapInArrow(extend, _RELATION)  # what it is told, then the block


def phrases(docs: DataFrame, longest: int = 3, least: int = 10, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, words, f) of all phrases of up to `longest` words that occur at least `least` times; (lang, n) of all words."""

    def stored(frame: DataFrame, **options: str) -> DataFrame:
        with by_batches(frame.sparkSession, BATCH):
            return written(frame, **options)

    relation = stored(occurrences(docs, text, lang), **LARGE_ROWS)
    totals = stored(relation.groupBy("lang").agg(F.sum("n").alias("n")))
    out = before = None
    for k in range(1, longest + 1):
        told = stored(counted(relation, least), **LARGE_ROWS)
        flat = told.where("id is not null").select("lang", F.explode(F.arrays_zip("id", "a", "b", "f", *(["spelt"] if k == 1 else []))).alias("x")).select("lang", "x.*")
        if k == 1:
            own = flat.select("lang", "id", F.array("spelt").alias("words"), "f")
        else:
            left, right = before.select(F.col("id").alias("a"), "words"), before.select(F.col("id").alias("b"), F.element_at("words", -1).alias("last"))
            own = flat.join(left, "a").join(right, "b").select("lang", "id", F.concat("words", F.array("last")).alias("words"), "f")
        before = stored(own)
        out = before if out is None else out.unionByName(before)
        if k < longest:
            again = stored(longer(relation, told), **LARGE_ROWS)
            discard(relation, told)
            relation = again
        else:
            discard(relation, told)
    return out.select("lang", "words", "f"), totals


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """Each language's `top` phrases of 2 to `longest` words: lang, rank, phrase, a (its count), l and r (of its parts at the worst cut), n (words), score.

    The score of a cut is floor(10^6 a^2 / (l r)), a phrase's that of its worst cut. A phrase inside a longer one that has half
    of its occurrences is left out.
    """
    found, totals = phrases(docs, longest, least, text, lang)
    size = F.size("words")
    many = found.where(size > 1).withColumnRenamed("f", "a")
    cuts = many.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
    cuts = cuts.select("lang", "words", "a", "cut", F.slice("words", 1, F.col("cut")).alias("head"), F.slice("words", F.col("cut") + 1, size - F.col("cut")).alias("tail"))
    part = lambda words, f: found.select("lang", F.col("words").alias(words), F.col("f").alias(f))
    scored = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"])
    whole = lambda c: f"cast({c} as decimal(18,0))"
    score = F.expr(f"cast(1000000 as decimal(7,0)) * {whole('a')} * {whole('a')} div ({whole('l')} * {whole('r')})")
    best = scored.groupBy("lang", "words", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("x")).select("lang", "words", "a", "x.score", "x.l", "x.r")
    inside = many.where(size > 2).select("lang", "a", F.explode(F.expr("flatten(transform(sequence(2, size(words) - 1), k -> transform(sequence(1, size(words) - k + 1), i -> slice(words, i, k))))")).alias("words"))
    inside = inside.groupBy("lang", "words").agg(F.max("a").alias("most"))
    kept = best.join(inside, ["lang", "words"], "left").where("most is null or 100 * most < 50 * a").select("lang", F.array_join("words", " ").alias("phrase"), "a", "l", "r", "score")
    ranked = first_rows(kept, ["lang"], [F.desc("score"), F.desc("a"), "phrase"], top, name="rank")  # in parts of a language first
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")

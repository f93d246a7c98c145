"""Benchmark decontamination with a generalised suffix automaton of the test items.

Words are maximal runs of digits, a-z (A-Z lower-cased) and all characters from U+0080. A *window* is
10 consecutive words of an item; an item of fewer words, but at least one, is one window as a whole.
A document word inside any occurrence of a window is *hit*. The automaton of all items reads each
document once and holds, at each word, the longest match that ends there; a match of at least a
window's length marks the words and, through the automaton's item sets, the items.

Items are few beside the corpus but not assumed to be. Up to `max_shard_words` words of them are one automaton, which is
broadcast: no row is shuffled. More of them are dealt to *shards* of about so many words (long items in pieces that overlap by
a window less one word), whose automata are built in tasks and never meet the driver:

1. The texts are read once, against a bounded filter of the windows' fingerprints (`FILTER` bits, whatever the items' number),
   which is all that is broadcast. Texts with a window that it lets pass are candidates, each distinct one once.
2. A candidate's fingerprints join the windows' and name its shards. It travels to those; there it streams past the shard's
   automaton, which tells hits as the one automaton does, so a false fingerprint costs time alone. A shard with many
   candidates is dealt over several tasks.
3. Hits join the documents by 128-bit hashes and length of their texts.

A very long text is held as one list of words, in one task.

Defined results: null or word-less texts have no words and no hits; null or word-less items have no
windows; repeated documents are judged one by one; repeated items count once per item_id;
items without an id are hit as others are, count as one item together and have no id in the list's digest; empty
tables give empty results (no items: nothing is hit); extra columns pass through untouched.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import discard, encode, fields, from_row, in_row, parallelism, shape, slices, written
from .hashing import mix, word_hashes

WINDOW = 10
_KEEP = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if (c + 32 if 65 <= c <= 90 else c) in _KEEP else 32 for c in range(256))
_WORD = re.compile(rb"[^ ]+")


def words_of(text: str | None) -> list[bytes]:
    return encode(text).translate(_FOLD).split()


def _in_order(names: set[str | None]) -> list[str | None]:
    """Sorted names, the missing one last."""
    return sorted(names, key=lambda x: (x is None, x or ""))


class ItemAutomaton:
    """Generalised suffix automaton over word numbers, with the items of each state."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[int]] = [set()]
        self.names = _in_order({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        short: dict[int, set[int]] = {}
        self.shortest = window
        for name, words in items:
            if not words:
                continue
            last = 0
            for word in words:
                last = self._extend(last, self.vocabulary.setdefault(word, len(self.vocabulary)), ends)
                ends[last].add(number[name])
            if len(words) < window:
                short.setdefault(last, set()).add(number[name])
                self.shortest = min(self.shortest, len(words))
        by_length = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        for s in reversed(by_length):
            if self.link[s] > 0:
                ends[self.link[s]] |= ends[s]
        # home[s]: the state of the window that ends a match in s; whole[s]: short items that end it
        self.home, self.whole = [0] * len(self.link), [()] * len(self.link)
        for s in by_length:
            p = self.link[s]
            self.home[s] = self.home[p] if self.length[p] >= window else s if self.length[s] >= window else 0
            own = ((self.length[s], tuple(sorted(short[s]))),) if s in short else ()
            self.whole[s] = (*self.whole[p], *own) if p >= 0 else own
        homes = {h for h in self.home if h}
        self.items = {h: tuple(sorted(ends[h])) for h in homes}

    def _extend(self, last: int, c: int, ends: list[set[int]]) -> int:
        nxt, link, length = self.next, self.link, self.length

        def split(p: int, q: int) -> int:
            copy = len(link)
            nxt.append(dict(nxt[q]))
            link.append(link[q])
            length.append(length[p] + 1)
            ends.append(set())
            while p >= 0 and nxt[p].get(c) == q:
                nxt[p][c] = copy
                p = link[p]
            link[q] = copy
            return copy

        if (q := nxt[last].get(c)) is not None:
            return q if length[q] == length[last] + 1 else split(last, q)
        new = len(link)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        ends.append(set())
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else split(p, q)
        return new

    def read(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit word ranges [start, end), merged and in order, and the numbers of the items found."""
        n = len(words)
        if n < self.shortest or len(self.link) == 1:
            return [], set()
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, n)
        # a word that no item has resets the automaton, so only runs of known words are read
        edge = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False]))))
        starts, stops = edge[::2], edge[1::2]
        long = stops - starts >= self.shortest
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        nxt, link, length, window, home, whole = self.next, self.link, self.length, self.window, self.home, self.whole
        for a, b in zip(starts[long].tolist(), stops[long].tolist(), strict=True):
            state = size = 0
            for i, c in enumerate(ids[a:b].tolist(), a + 1):
                while state and c not in nxt[state]:
                    state = link[state]
                    size = length[state]
                state = nxt[state].get(c, 0)
                size = size + 1 if state else 0
                if size >= window:
                    spans.append((i - size, i))
                    found.update(self.items[home[state]])
                for k, names in whole[state]:
                    if k <= size:
                        spans.append((i - k, i))
                        found.update(names)
        return _merged(spans), found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


#: Bits of the windows' filter; slices of it are made by tasks.
FILTER, SLICE = 1 << 27, 1 << 16
#: Candidates that a task reads with one loading of a shard's automaton, about.
SHARE = 5000
_U = np.uint64


def _prints(words: np.ndarray, k: int) -> np.ndarray:
    """Fingerprints of all k consecutive words, given by their hashes."""
    n = len(words) - k + 1
    out = np.zeros(max(0, n), _U)
    for i in range(k if n > 0 else 0):
        out = out * _U(0xC2B2AE3D27D4EB4F) + mix(words[i : i + n], i)
    return mix(out, k)


def _hashed(words: list[bytes]) -> np.ndarray:
    return word_hashes([b" ".join(words)])[0]


def _own(items: DataFrame, item_id: str, text: str) -> DataFrame:
    return items.select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("string").alias("t")).where("t is not null").distinct()


def _pieces(items: DataFrame, window: int, most: int, shards: int) -> DataFrame:
    """(shard, i, t): the items' words, joined by blanks, in pieces of at most `most` words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for i, t, at in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                words = words_of(t)
                pieces = [words] if len(words) <= most else [words[a : a + most] for a in range(0, len(words) - window + 1, most - window + 1)]
                out += [((at + k) % shards, i, b" ".join(own).decode("utf-8", "replace")) for k, own in enumerate(pieces) if own]
            columns = list(zip(*out, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.string()) for c in columns[1:])], names=["shard", "i", "t"])

    at = F.pmod(F.xxhash64("i", "t"), F.lit(shards)).alias("at")
    return items.select("i", "t", at).mapInArrow(cut, shape(*fields("shard bigint, i string, t string")))


def _windows(pieces: DataFrame, window: int) -> DataFrame:
    """(shard, k, print) of the pieces' windows of k words, each once a shard."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for shard, t in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                words = _hashed(t.as_py().encode().split())
                k = min(window, len(words))
                found = np.unique(_prints(words, k)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), shard)), pa.array(np.full(len(found), k, np.int32)), pa.array(found)], names=["shard", "k", "print"])

    return pieces.mapInArrow(tell, shape(*fields("shard bigint, k int, print bigint"))).distinct()


def _filter(windows: DataFrame) -> np.ndarray:
    """The bits of the windows' fingerprints; tasks make slices of it, the driver puts the slices together."""

    def fill(table: pa.Table) -> pa.Table:
        bits = np.zeros(SLICE, np.uint8)
        bits[table.column("bit").to_numpy()] = 1
        return pa.table({"part": table.column("part").slice(0, 1), "bits": pa.array([np.packbits(bits).tobytes()])})

    at = F.pmod("print", F.lit(FILTER))
    made = windows.select((at / SLICE).cast("int").alias("part"), (at % SLICE).cast("int").alias("bit")).distinct().groupBy("part").applyInArrow(fill, shape(*fields("part int, bits binary")))
    out = np.zeros(FILTER // 8, np.uint8)
    for row in made.collect():  # FILTER / 8 bytes at most
        out[row.part * SLICE // 8 : (row.part + 1) * SLICE // 8] = np.frombuffer(row.bits, np.uint8)
    return out


def _sharded_hits(texts: DataFrame, items: DataFrame, window: int, most: int, shards: int) -> DataFrame:
    """texts: h1, h2, n (what names a text) and t. (h1, h2, n, hits: array of starts, ends, items) of the distinct texts with a hit."""
    spark = texts.sparkSession
    keys = ["h1", "h2", "n"]
    pieces = written(_pieces(items, window, most, shards))
    windows = written(_windows(pieces, window))
    sizes = sorted(r.k for r in windows.select("k").distinct().collect())  # at most `window` numbers
    shared = spark.sparkContext.broadcast(_filter(windows))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts with a fingerprint that the filter lets pass, and these fingerprints."""
        bits = shared.value
        for batch in slices(batches):
            at, found = [], []
            for i, t in enumerate(batch.column(3)):
                words = words_of(t.as_py())
                if words:
                    hashes = _hashed(words)
                    prints = np.unique(np.concatenate([_prints(hashes, k) for k in sizes if k <= len(hashes)] or [np.zeros(0, _U)]))
                    place = (prints.view(np.int64) % FILTER).astype(np.int64)
                    prints = prints[(bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1]
                    if len(prints):
                        at.append(i)
                        found.append(prints.view(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(at, pa.int64())) for c in range(4)), pa.array(found, pa.list_(pa.int64()))], names=[*keys, "t", "prints"])

    kinds = shape(*((f.name, f.dataType) for f in texts.schema.fields), ("prints", "array<bigint>"))
    candidates = written(texts.where("t is not null").mapInArrow(sift, kinds).dropDuplicates(keys))
    named = candidates.select(*keys, F.explode("prints").alias("print")).join(windows.select("print", "shard").distinct(), "print").select(*keys, "shard").distinct()

    def build(table: pa.Table) -> pa.Table:
        own = list(zip(table.column("i").to_pylist(), (t.encode().split() for t in table.column("t").to_pylist()), strict=True))
        return pa.table({"shard": table.column("shard").slice(0, 1), "automaton": pa.array([pickle.dumps(ItemAutomaton(own, window))], pa.binary())})

    automata = pieces.groupBy("shard").applyInArrow(build, shape(*fields("shard bigint, automaton binary")))
    named = written(named)
    salts = named.groupBy("shard").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("salts"))
    dealt = named.join(salts, "shard").withColumn("salt", F.pmod(F.xxhash64("h2"), F.col("salts")).cast("int")).join(candidates.select(*keys, "t"), keys)
    loads = automata.join(salts, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "automaton")
    rows = dealt.select("shard", "salt", F.lit(1).alias("reads"), *keys, "t").unionByName(loads.withColumn("reads", F.lit(0)), allowMissingColumns=True)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = None
        for batch in slices(batches, 16):
            out = []
            for i, (reads, t, blob) in enumerate(zip(*(batch.column(c) for c in ("reads", "t", "automaton")), strict=True)):
                if not reads.as_py():
                    automaton = None  # one at a time
                    automaton = pickle.loads(blob.as_py())  # noqa: S301, made by `build` above
                    continue
                spans, names = automaton.read(words_of(t.as_py()))
                if spans:
                    out.append((i, [a for a, _ in spans], [b for _, b in spans], _in_order({automaton.names[x] for x in names})))
            at, starts, ends, names = zip(*out, strict=True) if out else ([], [], [], [])
            many = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(at, pa.int64())) for c in keys), pa.array(starts, many), pa.array(ends, many), pa.array(names, pa.list_(pa.string()))], names=[*keys, "starts", "ends", "items"])

    kinds = shape(*((k, texts.schema[k].dataType) for k in keys), *fields("starts array<bigint>, ends array<bigint>, items array<string>"))
    found = written(rows.repartition(parallelism(spark), "shard", "salt").sortWithinPartitions("shard", "salt", "reads").mapInArrow(read, kinds))
    discard(pieces, windows, candidates, named)
    return found.groupBy(*keys).agg(F.collect_list(F.struct("starts", "ends", "items")).alias("hits"))


def _scan(docs: DataFrame, keep: list[str], items: DataFrame, text: str, item_id: str, item_text: str, window: int, most: int, told: str, finish: Callable[[pa.Array, pa.Array, list[int], list[list[tuple[int, int]]], list[list[str | None]]], pa.RecordBatch]) -> DataFrame:
    """What `finish` makes of a batch's rows (the kept columns), texts, numbers of words, hit spans and items."""
    spark = docs.sparkSession
    frame = docs.select(in_row(docs, keep), F.col(text).cast("string").alias("t"))
    made = shape(("row", frame.schema["row"].dataType), *fields(told))
    own = _own(items, item_id, item_text)
    chars = own.agg(F.sum(F.length("t") + 1)).first()[0] or 0
    shards = max(1, -(-chars // (2 * most)))  # a word and its end take two characters at least
    if shards == 1:
        shared = spark.sparkContext.broadcast(ItemAutomaton([(r.i, words_of(r.t)) for r in own.toLocalIterator()], window))

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                texts = [words_of(x.as_py()) for x in batch.column(1)]
                hits = [shared.value.read(words) for words in texts]
                names = [_in_order({shared.value.names[i] for i in found}) for _, found in hits]
                yield finish(batch.column(0), batch.column(1), [len(words) for words in texts], [spans for spans, _ in hits], names)

        return frame.mapInArrow(read, made)

    keys = {"h1": F.xxhash64("t"), "h2": F.xxhash64(F.length("t"), "t"), "n": F.length("t")}
    hits = _sharded_hits(frame.select(*(c.alias(k) for k, c in keys.items()), "t"), own, window, most, shards)
    joined = frame.select("row", "t", *(c.alias(k) for k, c in keys.items())).join(hits, list(keys), "left").select("row", "t", "hits")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hits = [x or [] for x in batch.column(2).to_pylist()]
            spans = [_merged([s for x in own for s in zip(x["starts"], x["ends"], strict=True)]) for own in hits]
            names = [_in_order({name for x in own for name in x["items"]}) for own in hits]
            yield finish(batch.column(0), batch.column(1), [len(words_of(x.as_py())) for x in batch.column(1)], spans, names)

    return joined.mapInArrow(gather, made)


def find_hits(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, max_shard_words: int = 100_000) -> DataFrame:
    """One row per document: its id, n_words, starts and ends (word ranges hit, in order), items (sorted ids found, null last for items without one)."""

    def finish(rows: pa.Array, texts: pa.Array, n_words: list[int], spans: list[list[tuple[int, int]]], names: list[list[str | None]]) -> pa.RecordBatch:
        many = pa.list_(pa.int64())
        cols = [pa.array(n_words, pa.int64()), *(pa.array([[x[k] for x in own] for own in spans], many) for k in (0, 1)), pa.array(names, pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays([rows, *cols], names=["row", "n_words", "starts", "ends", "items"])

    found = _scan(docs, [doc_id], items, text, item_id, item_text, window, max_shard_words, "n_words bigint, starts array<bigint>, ends array<bigint>, items array<string>", finish)
    return found.select(*from_row([doc_id]), "n_words", "starts", "ends", "items")


def hit_digest(hits: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The digest columns of `find_hits`: counts, the hash of the item ids, and whether anything was hit."""
    n_hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("bigint"), lambda s, x: s + x)
    return hits.select(doc_id, "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, max_coverage: float = 0.8, max_shard_words: int = 100_000) -> DataFrame:
    """The documents without their hit spans; those hit over more than `max_coverage` of their words go.

    A span goes from its first word's first byte to its last word's last, a line end stays in its place. What
    then meets is not read again: the line end keeps it apart for readers, and no text is put together anew.
    """

    def finish(rows: pa.Array, texts: pa.Array, n_words: list[int], spans: list[list[tuple[int, int]]], names: list[list[str | None]]) -> pa.RecordBatch:
        out = texts.to_pylist()
        for i, own in enumerate(spans):
            if own:
                out[i] = without(out[i], [a for a, _ in own], [b for _, b in own])
        keep = pa.array([sum(b - a for a, b in own) <= max_coverage * n for own, n in zip(spans, n_words, strict=True)], pa.bool_())
        return pa.RecordBatch.from_arrays([rows, pa.array(out, pa.string())], names=["row", "t"]).filter(keep)

    clean = _scan(docs, [c for c in docs.columns if c != text], items, text, item_id, item_text, window, max_shard_words, "t string", finish)
    return clean.select(*(F.col("t").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns))


def without(value: str, starts: list[int], ends: list[int]) -> str:
    """The text without the words of these ranges."""
    data = encode(value)
    at = [m.span() for m in _WORD.finditer(data.translate(_FOLD))]
    out, last = [], 0
    for a, b in zip(starts, ends, strict=True):
        out += [data[last : at[a][0]], b"\n"]
        last = at[b - 1][1]
    return b"".join([*out, data[last:]]).decode()

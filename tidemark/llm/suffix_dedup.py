"""Suffix-array dedup: every byte of a `length`-byte string that also starts anywhere else is removed.

Exact over all documents, within one document too; strings are judged on the input, matches never cross documents.
A full suffix array would sort every byte's suffix; this one is sparse, and loses nothing:

1. Anchors. Of each `length`-byte window, the `ANCHOR`-byte string in it of the least fingerprint (the leftmost of
   equals) is its anchor: equal windows have equal anchors at equal places. Consecutive windows of one anchor are a
   *run*. The suffixes at the anchors, about one in `(length - ANCHOR) / 2` bytes, are sorted: sampled splitters
   range-partition them by their leading bytes, each bucket is sorted by multikey quicksort (leading bytes, then what
   stands for the bytes after them: the fingerprint of the anchor, then one and a half of the run's whole text), and
   neighbours are compared. Runs whose whole text has an equal are repeated throughout; runs whose anchor has no
   equal have no repeated window.
2. The rest, at the borders of repeated passages, sorts the suffix of each of its windows in the same way, by
   leading bytes and two independent fingerprints of `length` bytes; windows with an equal neighbour are repeated. Of
   runs repeated throughout that share an anchor with the rest, each text takes part once, to be met.

Texts are never sent beside their suffixes to be compared byte by byte, as that would shuffle a text's bytes many times.
Equal means equal leading bytes and 128 bits of independent fingerprints (of a run beside its anchor: 96 bits), and a
document is known by 96 bits of its id and text: at 10^13 suffixes a false match has a chance of about 10^-12. Records
travel plane by plane, sorted by leading bytes, so that what those of a bucket share takes no room.

A group of equals may lie across a boundary, as splitters cut anywhere, hot groups included: a mapper that holds such
a record also sends its key, once, to the group's other buckets, so neighbours are compared across boundaries.

`without_repeats` takes out repeated passages of `words` words beside those of `length` bytes, in the same sorts: words
(`[^\\x20\\x09-\\x0D]+`) stand for bytes there, by their hashes, so what is between them does not count. A passage goes from its
first word's first byte to its last word's last, and on to the edge of a text that it reaches. Both are judged on the input.

Defined results: very long texts are read in overlapping pieces, as if whole; null and texts shorter than `length` have nothing removed; equal texts, repeated rows included, remove
each other wholly if long enough (no copy is spared); ids are not compared, so ties do not arise; empty tables give empty
results; extra columns pass through `without_repeats` untouched.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import encode, packed, parallelism, shape, slices, unpacked, written
from .hashing import _to, blocks, mix, ranges, running, word_hashes, word_places

LENGTH = 400
#: Words of a repeated passage in `without_repeats`: all of over 50.
WORDS = 51
#: Added to the places that count words.
BY_WORD = 1 << 31
#: Share of a window that its anchor takes: longer anchors mean more of them, but fewer windows at a border.
ANCHOR_SHARE = 0.6
_U = np.uint64
#: A suffix: leading bytes; fingerprints of the anchor and, of the other kind, of the run, and half a first one of the run (of a window: both, and 0); document; place; windows (0: a key from another bucket).
SUFFIX = np.dtype([("lead", "<u4"), ("key", "<u8"), ("whole", "<u8"), ("check", "<u4"), ("ref", "<i8"), ("tag", "<i4"), ("at", "<u4"), ("n", "<u2")])
_KEYS = ("lead", "key", "whole", "check")
PLACE = np.dtype([("ref", "<i8"), ("tag", "<i4"), ("at", "<u4")])
SEGMENT = 1 << 18
#: The driver sorts a sample of so many suffixes: documents (or two a bucket, if that is more), and of each.
SAMPLE_DOCS, SAMPLE_EACH = 2000, 16
#: Buckets of suffixes a partition: several small ones each, so that no partition has many more than another.
BUCKETS = 2


def _units(texts: list[bytes], flag: int) -> list[bytes | np.ndarray]:
    """What the texts' places count: bytes, or the hashes of words."""
    if not flag:
        return texts
    out = []
    for first, last in blocks(texts, SEGMENT):
        hashes, counts = word_hashes(texts[first:last])
        out += np.split(hashes, np.cumsum(counts)[:-1])
    return out


def _array(data: bytes | np.ndarray) -> np.ndarray:
    return np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data


Ref = tuple[int, int]


def _pieces(values: list[tuple[Ref, bytes | np.ndarray]], length: int) -> Iterator[list[tuple[Ref, int, bytes | np.ndarray]]]:
    """Blocks of (ref, offset, bytes or words); long texts in pieces that overlap by a window less one byte."""
    block, size = [], 0
    for ref, data in values:
        step = SEGMENT if len(data) > 2 * SEGMENT else len(data)
        for a in range(0, max(0, len(data) - length + 1), max(1, step)):
            part = data[a : a + step + length - 1]
            if len(part) >= length:
                block.append((ref, a, part))
                size += len(part)
                if size >= SEGMENT:
                    yield block
                    block, size = [], 0
    if block:
        yield block


def _lead(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    if data.dtype == _U:
        return (mix(data[at] + mix(data[at + 1])) >> _U(32)).astype(np.uint32)
    out = np.zeros(len(at), np.uint32)
    for j in range(4):
        out = (out << np.uint32(8)) | data[at + j]
    return out


def _runs(block: list[tuple[Ref, int, bytes | np.ndarray]], length: int, anchor: int) -> np.ndarray:
    """The anchors' suffixes of a block."""
    data = np.concatenate([_array(p) for _, _, p in block])
    sizes = np.array([len(p) for _, _, p in block])
    begin = np.cumsum(sizes) - sizes
    sums = running(data)
    n = len(data) - anchor + 1
    prints = mix((sums[anchor:] - sums[:-anchor]) * _to(len(sums))[1][:n])
    least = (prints & ~_U(0xFFFFFF)) | np.arange(n, dtype=_U)
    width, have = length - anchor + 1, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if width > have:
        least = np.minimum(least[: have - width], least[width - have :])
    place = (least & _U(0xFFFFFF)).astype(np.int64)  # of each window that starts in the block
    piece = np.repeat(np.arange(len(block)), sizes)[: len(place)]
    valid = np.arange(len(place)) <= (begin + sizes - length)[piece]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (piece[1:] != piece[:-1])
    first = np.flatnonzero(new & valid)
    stop = np.append(np.flatnonzero(new), len(place))
    last = stop[np.searchsorted(stop, first, side="right")]
    last = np.minimum(last, (begin + sizes - length + 1)[piece[first]])
    out = np.zeros(len(first), SUFFIX)
    own = piece[first]
    out["lead"], out["key"] = _lead(data, place[first]), prints[place[first]]
    out["whole"] = ranges(running(data, second=True), first, last - 1 + length)
    out["check"] = ranges(sums, first, last - 1 + length) >> _U(32)
    out["ref"], out["tag"] = np.array([r for r, _, _ in block], np.int64).T[:, own]
    out["at"] = first - begin[own] + np.array([a for _, a, _ in block])[own]
    out["n"] = last - first
    return out


def _windows(data: bytes | np.ndarray, ref: Ref, at: np.ndarray, n: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """The suffixes of the windows of these runs of a text, piece by piece."""
    for a in range(0, len(data) - length + 1, SEGMENT):
        inside = (at < a + SEGMENT) & (at + n > a)
        if not inside.any():
            continue
        lo, hi = np.maximum(at[inside], a), np.minimum((at + n)[inside], a + SEGMENT)
        starts = np.concatenate([np.arange(x, y) for x, y in zip(lo, hi, strict=True)])
        part = _array(data)[a : a + SEGMENT + length - 1]
        out = np.zeros(len(starts), SUFFIX)
        out["lead"] = _lead(part, starts - a)
        out["key"] = ranges(running(part), starts - a, starts - a + length)
        out["whole"] = ranges(running(part, second=True), starts - a, starts - a + length)
        out["ref"], out["tag"] = ref
        out["at"], out["n"] = starts, 1
        yield out


def _keys(records: np.ndarray) -> list[tuple]:
    return list(zip(*(records[c].tolist() for c in (*_KEYS, "ref", "tag", "at")), strict=True))


def _splitters(sample: DataFrame, buckets: int) -> list[tuple]:
    """Keys that cut a bounded sample of suffixes (rows of packed records) into equal parts."""
    rows = sample.collect()
    keys = sorted(_keys(np.frombuffer(b"".join(r[0] for r in rows), SUFFIX)))
    return [keys[len(keys) * i // buckets] for i in range(1, buckets)] if len(keys) >= buckets else sorted(set(keys))[: buckets - 1]


def _dealt(records: np.ndarray, splitters: list[tuple]) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed records), with the keys of groups that reach over a boundary sent to the group's other buckets."""
    leads = np.array([s[0] for s in splitters], np.uint32)
    lead = records["lead"].astype(np.uint32)
    bucket = np.searchsorted(leads, lead, side="right")
    unsure = np.flatnonzero(np.isin(lead, leads))
    groups = [s[:2] for s in splitters]
    told: dict[int, set[tuple]] = {}
    if len(unsure):
        keys = _keys(records[unsure])
        exact = [bisect_right(splitters, key) for key in keys]
        bucket[unsure] = exact
        cut = set(groups)
        for key, b in zip(keys, exact, strict=True):
            if key[:2] in cut:
                for other in range(bisect_left(groups, key[:2]), bisect_right(groups, key[:2]) + 1):
                    if other != b:
                        told.setdefault(other, set()).add(key[: len(_KEYS)])
    order = np.lexsort((lead, bucket))
    ends = np.searchsorted(bucket[order], np.arange(len(splitters) + 2))
    for b in range(len(splitters) + 1):
        more = np.zeros(len(told.get(b, ())), SUFFIX)
        if len(more):
            for c, values in zip(_KEYS, zip(*told[b], strict=True), strict=True):
                more[c] = np.array(values, SUFFIX[c])
        if ends[b + 1] > ends[b] or len(more):
            own = np.concatenate((records[order[ends[b] : ends[b + 1]]], more))
            yield b, packed(*(own[c] for c in SUFFIX.names))


def multikey_quicksort(keys: np.ndarray) -> np.ndarray:
    """Order of rows by their columns, by multikey quicksort: a stretch is parted by a pivot's key at one depth into less,
    equal and greater; the equal part goes on with the next key. All open stretches are parted together, round by round."""
    n, depths = keys.shape
    order = np.arange(n)
    begin, size, depth = np.array([0]), np.array([n]), np.array([0])
    while len(begin := begin[keep := (size > 1) & (depth < depths)]):
        size, depth = size[keep], depth[keep]
        first = np.cumsum(size) - size
        own = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(own)) + (begin - first)[own]
        value = keys[order[at], depth[own]]
        low, mid, high = value[first], value[first + size // 2], value[first + size - 1]
        pivot = np.maximum(np.minimum(low, mid), np.minimum(np.maximum(low, mid), high))[own]
        side = (value >= pivot).astype(np.int8) + (value > pivot)
        counts = np.bincount(own * 3 + side, minlength=3 * len(size)).reshape(-1, 3)
        starts = begin[:, None] + np.cumsum(counts, 1) - counts
        moved = order[at]
        for s in range(3):
            inside = np.flatnonzero(side == s)
            done = np.cumsum(counts[:, s]) - counts[:, s]
            order[starts[own[inside], s] + np.arange(len(inside)) - done[own[inside]]] = moved[inside]
        begin, size, depth = starts.ravel(), counts.ravel(), (depth[:, None] + np.array([0, 1, 0])).ravel()
    return order


def _neighbours(payload: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's suffixes in order; whether each one's lead and key, and all its keys, have an equal."""
    records = np.empty(sum(map(len, payload)) // SUFFIX.itemsize, SUFFIX)
    at = 0
    for part in payload:
        n = len(part) // SUFFIX.itemsize
        for c, values in zip(SUFFIX.names, unpacked(part, *(SUFFIX[c] for c in SUFFIX.names)), strict=True):
            records[c][at : at + n] = values
        at += n
    keys = np.stack([records[c].astype(_U) for c in _KEYS], 1)
    order = multikey_quicksort(keys)
    equal = keys[order[1:]] == keys[order[:-1]]
    either = lambda x: np.append(x, False) | np.insert(x, 0, False)
    return records[order], either(equal[:, :2].all(1)), either(equal.all(1))


def _sorted(packed: Callable[[pa.RecordBatch], Iterator[np.ndarray]], source: DataFrame, sample: DataFrame, kinds: T.StructType, judged: Callable[[np.ndarray, np.ndarray, np.ndarray], pa.Table]) -> DataFrame:
    """Suffixes that `packed` makes of source's batches, range-partitioned, sorted and judged bucket by bucket."""
    spark = source.sparkSession

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            # at most SAMPLE_EACH suffixes a document, wherever in these documents they stand
            out = [r[:: -(-len(r) // (SAMPLE_EACH * part.num_rows))].tobytes() for r in [np.concatenate([np.zeros(0, SUFFIX), *packed(part)])] if len(r)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["s"])

    splitters = spark.sparkContext.broadcast(_splitters(sample.mapInArrow(some, "s binary"), BUCKETS * parallelism(spark)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1024):
            made = list(packed(part))
            if made:
                rows = list(_dealt(np.concatenate(made), splitters.value))
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())], names=["bucket", "s"])

    def sort(table: pa.Table) -> pa.Table:
        return judged(*_neighbours(table.column("s").to_pylist()))

    return source.mapInArrow(deal, shape(("bucket", "bigint"), ("s", "binary"))).groupBy("bucket").applyInArrow(sort, kinds)


def _covered(starts: np.ndarray, ends: np.ndarray, touching: bool = True) -> list[tuple[int, int]]:
    """The union of ranges, in order; ranges that only touch are one if `touching`."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > reach[:-1] if touching else starts[1:] >= reach[:-1])
    first = np.flatnonzero(new)
    return list(zip(starts[first].tolist(), reach[np.append(first[1:], len(starts)) - 1].tolist(), strict=True))


def _byte_ranges(data: bytes, at: np.ndarray, n: np.ndarray, length: int, flag: int) -> list[tuple[int, int]]:
    """The bytes that n windows of one measure from each place cover, in order."""
    own = (at & BY_WORD) == flag
    spans = _covered(at[own] - flag, at[own] - flag + n[own] - 1 + length, touching=not flag)  # what is between words stays between passages
    if flag and spans:
        first, last = word_places(np.frombuffer(data + b"\n", np.uint8))
        spans = [(int(first[a]) if a else 0, int(last[b - 1]) if b < len(last) else len(data)) for a, b in spans]
    return spans


_OUT = [("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string"), ("n_passage_bytes", "bigint"), ("kept", "string")]
_NAMES = [name for name, _ in _OUT]


def _finished(data: list[bytes], marks: list[tuple[np.ndarray, np.ndarray]], measures: list[tuple[int, int]], want_text: bool) -> list[pa.Array]:
    """The columns of _OUT; marks: places and numbers of repeated windows. Counts and hash are of the first measure, n_passage_bytes and text of all."""
    removed, passages, sums, texts, n_spans = [], [], [], [], []
    for d, (at, n) in zip(data, marks, strict=True):
        spans = [_byte_ranges(d, at, n, *m) for m in measures] if len(at) else [[]]
        every = _covered(*np.array([x for s in spans for x in s], np.int64).reshape(-1, 2).T)
        chosen = every if want_text else spans[0]
        edges = [0, *(x for s in chosen for x in s), len(d)]
        kept = b"".join(d[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if chosen else d
        removed.append(sum(b - a for a, b in spans[0]))
        passages.append(sum(b - a for a, b in every))
        n_spans.append(len(spans[0]))
        sums.append(None if want_text else hashlib.sha256(kept).hexdigest())
        texts.append(kept.decode("utf-8", "ignore") if want_text else None)
    whole = pa.int64()
    return [pa.array([len(d) for d in data], whole), pa.array(removed, whole), pa.array(n_spans, whole), pa.array(sums, pa.string()), pa.array(passages, whole), pa.array(texts, pa.string())]


def _judge(docs: DataFrame, keep: list[str], doc_id: str, text: str, measures: list[tuple[int, int]], want_text: bool) -> DataFrame:
    """(row: the kept columns, and _OUT's; a hash or else the text without repeats). measures: (length, 0 or BY_WORD)."""
    ref, tag = F.xxhash64(doc_id, text).alias("ref"), F.hash(text, doc_id).alias("tag")
    texts = docs.select(ref, tag, F.col(text).cast("string").alias("t"))
    count = docs.count()

    def few(frame: DataFrame, n: int) -> DataFrame:
        return frame.sample(min(1.0, max(SAMPLE_DOCS, 2 * parallelism(docs.sparkSession)) / max(1, n)), seed=7)

    def anchors(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for first in range(0, batch.num_rows, 256):  # few texts in hand at a time
            part = batch.slice(first, 256)
            refs = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True))
            data = [encode(x.as_py()) for x in part.column(2)]
            for length, flag in measures:
                for block in _pieces(list(zip(refs, _units(data, flag), strict=True)), length):
                    out = _runs(block, length, max(4, int(length * ANCHOR_SHARE)))
                    out["at"] += np.uint32(flag)
                    yield out

    def runs(records: np.ndarray, same: np.ndarray, whole: np.ndarray) -> pa.Table:
        """Runs whose anchor has an equal. Of a group with runs that are not repeated throughout, each text that is goes on too, once, for their windows to meet."""
        differs = lambda *names: np.append(True, np.any([records[c][1:] != records[c][:-1] for c in names], 0))[: len(records)]
        fresh = differs("lead", "key")
        group = np.cumsum(fresh) - 1
        mixed = np.bincount(group, weights=~whole | (records["n"] == 0)) > 0
        real = np.flatnonzero(records["n"] > 0)
        kind = np.cumsum(differs(*_KEYS))
        first = np.zeros(len(records), bool)
        first[real[np.append(True, kind[real][1:] != kind[real][:-1])[: len(real)]]] = True
        found = same & (records["n"] > 0)
        r = records[found]
        return pa.table({"ref": r["ref"].copy(), "tag": r["tag"].copy(), "at": r["at"].astype(np.int64), "n": r["n"].astype(np.int64), "whole": whole[found], "meets": (~whole | (first & mixed[group]))[found]})

    marks = _sorted(anchors, texts, few(texts, count), shape(("ref", "bigint"), ("tag", "int"), ("at", "bigint"), ("n", "bigint"), ("whole", "boolean"), ("meets", "boolean")), runs)
    # a document's runs: in one list, as the document is in one row itself
    marks = marks.distinct().groupBy("ref", "tag").agg(F.collect_list(F.struct("at", "n", "whole", "meets")).alias("m"))
    row = F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row")
    joined = docs.select(row, ref, tag, F.col(text).cast("string").alias("t")).join(marks, ["ref", "tag"], "left").select("row", "ref", "tag", "t", "m.at", "m.n", "m.whole", "m.meets")
    lists = ("full_at", "full_n", "at", "n")  # windows known as repeated, and those that have yet to meet others

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            known, rest = [], []
            for own in zip(*(batch.column(c) for c in ("at", "n", "whole", "meets")), strict=True):
                at, n, whole, meets = (np.array(x.as_py() or [], np.int64) for x in own)
                known.append((at[whole > 0], n[whole > 0]))
                rest.append((at[meets > 0], n[meets > 0]))
            done = pa.array([len(a) == 0 for a, _ in rest], pa.bool_())
            data = [encode(x.as_py()) if d.as_py() else b"" for x, d in zip(batch.column(3), done, strict=True)]
            cols = _finished(data, [k if len(a) == 0 else (a[:0], a[:0]) for k, (a, _) in zip(known, rest, strict=True)], measures, want_text)
            many = [pa.array([None if d.as_py() else v.tolist() for v, d in zip(own, done, strict=True)], pa.list_(pa.int64())) for own in ([a for a, _ in known], [n for _, n in known], [a for a, _ in rest], [n for _, n in rest])]
            texts = pa.array([None if d.as_py() else x for x, d in zip(batch.column(3).to_pylist(), done, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(3)), *cols, done, texts, *many], names=["row", "ref", "tag", *_NAMES, "done", "t", *lists])

    kind = ("row", joined.schema["row"].dataType)
    first = written(joined.mapInArrow(first_pass, shape(kind, ("ref", "bigint"), ("tag", "int"), *_OUT, ("done", "boolean"), ("t", "string"), *((c, "array<bigint>") for c in lists))))
    bordered = first.where("not done")
    borders = bordered.select("ref", "tag", "t", "at", "n")

    def windows(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for ref, tag, x, at, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *(batch.column(c) for c in (2, 3, 4)), strict=True):
            data, at, n = encode(x.as_py()), np.array(at.as_py(), np.int64), np.array(n.as_py(), np.int64)
            for length, flag in measures:
                own = (at & BY_WORD) == flag
                if own.any():
                    for out in _windows(_units([data], flag)[0], (ref, tag), at[own] - flag, n[own], length):
                        out["at"] += np.uint32(flag)
                        yield out

    places = parallelism(docs.sparkSession)

    def repeated(records: np.ndarray, same: np.ndarray, whole: np.ndarray) -> pa.Table:
        """Repeated windows, packed by where their document is to be put together: a row a destination, not a document."""
        r = records[whole & (records["n"] > 0)][["ref", "tag", "at"]]
        to = (mix(r["ref"].copy().view(_U)) % _U(places)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        ends = np.searchsorted(to[order], np.arange(places + 1))
        full = [k for k in range(places) if ends[k + 1] > ends[k]]
        place = np.zeros(len(r), PLACE)
        for c in PLACE.names:
            place[c] = r[c][order]
        return pa.table({"to": pa.array(full, pa.int64()), "s": pa.array([place[ends[k] : ends[k + 1]].tobytes() for k in full], pa.binary())})

    def together(table: pa.Table) -> pa.Table:
        r = np.sort(np.frombuffer(b"".join(table.column("s").to_pylist()), PLACE), order=PLACE.names)
        new = np.append(True, (r["ref"][1:] != r["ref"][:-1]) | (r["tag"][1:] != r["tag"][:-1]))[: len(r)]
        starts = np.append(np.flatnonzero(new), len(r)).astype(np.int32)
        return pa.table({"ref": r["ref"][new].copy(), "tag": r["tag"][new].copy(), "found": pa.ListArray.from_arrays(pa.array(starts), pa.array(r["at"].astype(np.int64)))})

    found = _sorted(windows, borders, few(borders, bordered.count()), shape(("to", "bigint"), ("s", "binary")), repeated)
    found = found.groupBy("to").applyInArrow(together, "ref bigint, tag int, found array<bigint>")
    second = bordered.select("row", "ref", "tag", "t", "full_at", "full_n").join(found, ["ref", "tag"], "left").select("row", "t", "full_at", "full_n", "found")

    def last_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            marks = []
            for own in zip(*(batch.column(c) for c in (2, 3, 4)), strict=True):
                at, n, more = (np.array(x.as_py() or [], np.int64) for x in own)
                marks.append((np.concatenate((at, more)), np.concatenate((n, np.ones(len(more), np.int64)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), *_finished([encode(x.as_py()) for x in batch.column(1)], marks, measures, want_text)], names=["row", *_NAMES])

    return first.where("done").select("row", *_NAMES).unionByName(second.mapInArrow(last_pass, shape(kind, *_OUT)))


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, words: int | None = None) -> DataFrame:
    """One row per document: its id, n_bytes, n_removed, n_spans, kept_sha256; with `words`, n_passage_bytes too: the bytes that `without_repeats` would take out."""
    measures = [(length, 0)] + ([(words, BY_WORD)] if words else [])
    out = _judge(docs, [doc_id], doc_id, text, measures, want_text=False)
    return out.select(F.col("row").getField(doc_id).alias(doc_id), "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["n_passage_bytes"] if words else []))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, words: int = WORDS) -> DataFrame:
    """The documents with all their columns, their texts without the removed bytes (and characters cut by them); documents left empty by it go."""
    out = _judge(docs, [c for c in docs.columns if c != text], doc_id, text, [(length, 0), (words, BY_WORD)], want_text=True).where("n_passage_bytes = 0 or kept <> ''")
    return out.select(*(F.col("kept").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns))

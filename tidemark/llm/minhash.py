"""MinHash near-dedup with SuperMinHash signatures, banding, exact verification and union-find grouping.

A document's set: the distinct k-word shingles of its text (A-Z lower-cased, words `[^\\x20\\x09-\\x0D]+`); with
fewer words the whole sequence as one; without words none. Two documents are linked if
100 * |intersection| >= percent * |union|; components of links are the groups. Equal sets are one *class*
(found by a 128-bit digest, pre-aggregated), so copies cost one row each and never pairs.

SuperMinHash gives an element a random rank in each of the m slots from one random permutation: value j + r in the
slot that the permutation has at j. All elements take step 0, then those of documents whose slots do not all hold
values below 1 take step 1, and so on: long texts stop after a few steps. 180 slots in 36 bands of 5: a pair at
similarity 0.8 shares no band with probability (1 - 0.8^5)^36 = 6e-7.

Candidates of a band bucket are not paired with each other. A bucket's *centre* is its member with the largest
buckets; buckets of one centre are one family. First every member meets its centre, and the links found are joined up.
Then, in families that still hold several components, the members outside the main one are held in blocks of bounded
size and every member streams past them, with exact intersections from the blocks' sorted shingles. So every pair of a
bucket is in one component already or has been compared, no pairs are written, and rows grow with members, times the
blocks that a large family needs.

Defined results: very long texts are hashed in stretches, their sets are whole; null or word-less texts have empty sets, n_shingles 0, and are linked with nothing; repeated rows
and equal texts belong together and each row is returned; component_id is the least id of the component, so ties do
not arise; empty tables give empty results; extra columns pass through `keep_one` and `keep_one_row` untouched. In
`keep_one` rows of equal id are all kept or all dropped and rows without an id are kept; `keep_one_row` looks at rows,
not ids, and keeps exactly one row of each component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import LOWER_ASCII, discard, encode, fields, from_row, in_row, parallelism, shape, slices, written
from .components import components
from .hashing import blocks, mix, shingles

SLOTS, ROWS = 180, 5
_U = np.uint64
#: Sets that a task holds while as many others stream past: at least, and at most.
CHUNK, MOST = 128, 2048


def signatures(elements: np.ndarray, sizes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of many sets (hashes one set after the other, their sizes): (sets, slots) of uint64, rank * 2^32 + fraction."""
    n = len(sizes)
    out = np.full(n * slots, np.iinfo(np.uint64).max, _U)
    owner = np.repeat(np.arange(n), sizes)
    moved: list[tuple[np.ndarray, np.ndarray]] = []  # of each step: the place swapped with it, and what went there
    x = elements.astype(_U)

    def content(place: np.ndarray) -> np.ndarray:
        """What the permutation holds at this place, by the swaps so far."""
        value = place.copy()
        for k, w in moved:
            value = np.where(k == place, w, value)
        return value

    for j in range(slots):
        if not len(x):
            break
        draw = mix(x, j + 1)
        place = (j + (draw >> _U(33)) % _U(slots - j)).astype(np.int64)
        slot, here = content(place), content(np.full(len(x), j))
        np.minimum.at(out, owner * slots + slot, (_U(j) << _U(32)) | (draw & _U(0xFFFFFFFF)))
        moved.append((place, here))
        unfinished = out.reshape(n, slots).max(1) >= _U(j + 1) << _U(32)
        active = unfinished[owner]
        if not active.all():
            x, owner = x[active], owner[active]
            moved = [(k[active], w[active]) for k, w in moved]
    return out.reshape(n, slots)


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a contiguous array as a binary column."""
    width = rows.dtype.itemsize * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(0, (len(rows) + 1) * width, width, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def _sets(texts: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of a text column: first, last, elements, sizes. Blocks are bounded by bytes, whatever the texts' lengths."""
    data = [encode(x.as_py()).translate(LOWER_ASCII) for x in texts]
    for a, b in blocks(data):
        yield a, b, *shingles(data[a:b], k)


def _digests(elements: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """128-bit digests of sets (n, 2)."""
    at = np.cumsum(sizes) - sizes
    both = np.zeros((len(sizes), 2), _U)
    full = sizes > 0
    for c in range(2):
        if full.any():
            both[full, c] = np.add.reduceat(mix(elements, 101 + c), at[full])
    both[:, 1] ^= sizes.astype(_U)
    both[~full] = 0
    return both


def _ref(doc_id: str, text: str) -> Column:
    """128 bits that name a row's id and text."""
    return F.struct(F.xxhash64(doc_id, text).alias("a"), F.xxhash64(F.lit(1), text, F.length(text), doc_id).alias("b")).alias("ref")


def sets_of(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """Each row's id, ref (128 bits of id and text), n_shingles, node (digest of its set) and bands."""
    frame = docs.select(F.col(doc_id).alias("id"), _ref(doc_id, text), F.col(text).cast("string").alias("t"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for a, b, elements, sizes in _sets(batch.column(2), k):
                part = batch.slice(a, b - a)
                keys = np.zeros((b - a, SLOTS // ROWS), _U)
                grouped = signatures(elements, sizes).reshape(b - a, SLOTS // ROWS, ROWS)
                for r in range(ROWS):
                    keys = mix(keys ^ grouped[:, :, r], r)
                keys = mix(keys + np.arange(SLOTS // ROWS, dtype=_U)).view(np.int64)
                offsets = np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes), _binary(_digests(elements, sizes)), pa.ListArray.from_arrays(offsets, keys.ravel())], names=["id", "ref", "n_shingles", "node", "bands"])

    return frame.mapInArrow(read, shape(("id", docs.schema[doc_id].dataType), ("ref", frame.schema["ref"].dataType), *fields("n_shingles bigint, node binary, bands array<bigint>")))


def _verified(pairs: DataFrame, active: DataFrame, k: int, percent: int) -> DataFrame:
    """pairs (a, b: nodes) -> (u, v): those that are linked. active: (node, t), one text a node.

    Every b travels to its a; an a with many partners is dealt over several salts. In a task the rows of an
    (a, salt) follow each other, a's own first, so only one set is held.
    """
    pairs = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(64)).cast("int").alias("salt"))
    own = pairs.select(F.col("a").alias("node"), F.col("a").alias("home"), "salt", F.lit(0).alias("far")).distinct()
    rows = own.unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("home"), "salt", F.lit(1).alias("far"))).join(active, "node")
    dealt = rows.select("node", "home", "far", "t", "salt").repartition(parallelism(pairs.sparkSession), "home", "salt").sortWithinPartitions("home", "salt", "far")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(0, _U)
        for batch in slices(batches):
            u, v = [], []
            for first, last, elements, sizes in _sets(batch.column(3), k):
                part = batch.slice(first, last - first)
                end = 0
                for node, home, far, size in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), sizes.tolist(), strict=True):
                    other = elements[end : end + size]
                    end += size
                    if not far:
                        own = other.copy()
                    elif len(own) and 100 * min(len(own), size) >= percent * max(len(own), size):
                        at = np.minimum(np.searchsorted(own, other), len(own) - 1)
                        common = int((own[at] == other).sum())
                        if 100 * common >= percent * (len(own) + size - common):
                            u.append(node)
                            v.append(home)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])

    return dealt.mapInArrow(compare, "u binary, v binary")


def _met_in_blocks(family: DataFrame, active: DataFrame, k: int, percent: int) -> DataFrame:
    """family (home, node, root) -> links (u, v) that join all components of each home that have a link between them.

    Members outside a home's main component are held in chunks, as one sorted list of shingles with their
    owners; every member of the home streams past and gets its exact intersection with all of them at once. Both sides
    are cut at a 16th of the home, but for MOST at most, so no unit of work holds more than an eighth of a home of over
    16 CHUNK members, whatever its size. A unit tells only links that join components that it has not joined yet.
    """
    sizes = family.groupBy("home", "root").agg(F.count("*").alias("c"))
    main = sizes.groupBy("home").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.sum("c").alias("n"), F.count("*").alias("roots"), F.max("c").alias("most")).where("roots > 1 and n > 2")
    side = F.least(F.lit(MOST), F.greatest(F.lit(CHUNK), F.ceil(F.col("n") / 16)))
    # a table of its own, so that this is a join of two plain shuffles, which Spark splits where a home is hot
    main = written(main.select("home", "main", F.ceil((F.col("n") - F.col("most")) / side).cast("int").alias("chunks"), F.ceil(F.col("n") / side).cast("int").alias("salts")))
    open_ = written(family.join(main, "home"))
    discard(main)
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
    held = open_.where("root <> main").select("home", own("chunks", 1).alias("chunk"), spread("salts").alias("salt"), F.lit(0).alias("streams"), "node", "root")
    streamed = open_.select("home", spread("chunks").alias("chunk"), own("salts", 2).alias("salt"), F.lit(1).alias("streams"), "node", "root")
    rows = held.unionByName(streamed).join(active, "node").select("home", "chunk", "salt", "streams", "node", "root", "t")
    dealt = rows.repartition(parallelism(family.sparkSession), "home", "chunk", "salt").sortWithinPartitions("home", "chunk", "salt", "streams")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parent = None, {}
        nodes, roots, parts, index = [], [], [], None

        def top(x: bytes) -> bytes:
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for batch in slices(batches):
            u, v = [], []
            for first, last, elements, sizes in _sets(batch.column(6), k):
                part = batch.slice(first, last - first)
                end = 0
                columns = zip(*(part.column(c).to_pylist() for c in range(6)), sizes.tolist(), strict=True)
                for home, chunk, salt, streams, node, root, size in columns:
                    own = elements[end : end + size]
                    end += size
                    if (home, chunk, salt) != block:
                        block, parent, nodes, roots, parts, index = (home, chunk, salt), {}, [], [], [], None
                    if not streams:
                        nodes.append(node)
                        roots.append(root)
                        parts.append(own.copy())
                        continue
                    if not nodes:
                        continue
                    if index is None:
                        counts = np.array([len(x) for x in parts])
                        every = np.concatenate(parts)
                        order = np.argsort(every, kind="stable")
                        index = every[order], np.repeat(np.arange(len(parts)), counts)[order]
                        parts = []
                    lo, hi = np.searchsorted(index[0], own, "left"), np.searchsorted(index[0], own, "right")
                    n = hi - lo
                    at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    common = np.bincount(index[1][at], minlength=len(nodes))
                    for i in np.flatnonzero(100 * common >= percent * (counts + size - common)).tolist():
                        if (x := top(roots[i])) != (y := top(root)):
                            parent[x] = y
                            u.append(nodes[i])
                            v.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])

    out = written(dealt.mapInArrow(compare, "u binary, v binary"))
    discard(open_)
    return out


def _linked(members: DataFrame, active: DataFrame, k: int, percent: int) -> DataFrame:
    """members (key, node, w) of buckets -> (node, root) of the components of all links between members of a bucket."""
    centre = members.groupBy("key").agg(F.max_by("node", F.struct("w", "node")).alias("home"))
    family = written(members.join(centre, "key").select("home", "node").distinct())
    stars = family.where("home <> node").select(F.col("home").alias("a"), F.col("node").alias("b"))
    verified = written(_verified(stars, active, k, percent))
    found = components(verified)
    roots = written(found)
    discard(verified, found)
    placed = family.join(roots, "node", "left").select("home", "node", F.coalesce("root", "node").alias("root"))
    more = _met_in_blocks(placed, active, k, percent)
    if more.limit(1).count():
        known, roots = roots, components(more.unionByName(roots.select(F.col("node").alias("u"), F.col("root").alias("v"))))
        discard(known)
    discard(family, more)
    return roots


def _grouped(docs: DataFrame, doc_id: str, text: str, k: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' sets, their classes (node, first), and (node, root) of the components of linked classes."""
    base = written(sets_of(docs, doc_id, text, k))
    classes = base.where("n_shingles > 0").groupBy("node").agg(F.min("id").alias("first"), F.min("ref").alias("ref"), F.min_by("bands", "ref").alias("bands"))
    rows = classes.select("node", "ref", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = written(rows.join(shared, "key"))
    weight = members.groupBy("node").agg(F.sum(F.log2("n")).alias("w"), F.min("ref").alias("ref"))
    texts = docs.select(_ref(doc_id, text), F.col(text).cast("string").alias("t"))
    active = written(weight.select("node", "ref").join(texts, "ref").select("node", "t").dropDuplicates(["node"]))
    roots = _linked(members.join(weight.select("node", "w"), "node").select("key", "node", "w"), active, k, percent)
    discard(members, active)
    return base, classes, roots


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: its id, n_shingles, component_id (least id reachable), kept (it is that document)."""
    base, classes, roots = _grouped(docs, doc_id, text, k, percent)
    least = classes.select("node", "first").join(roots, "node")
    names = least.groupBy("root").agg(F.min("first").alias("component"))
    of_node = least.join(names, "root").select("node", "component").unionByName(classes.join(roots, "node", "left_anti").select("node", F.col("first").alias("component")))
    component = F.coalesce("component", "id")
    out = base.select("id", "n_shingles", "node").join(of_node, "node", "left")
    return out.select(F.col("id").alias(doc_id), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, that of the least id, with all its columns."""
    dropped = near_duplicates(docs, doc_id, text, k, percent).where("not kept").select(F.col(doc_id).alias("id"))
    return docs.select(in_row(docs), F.col(doc_id).alias("id")).join(dropped, "id", "left_anti").select(*from_row(docs.columns))


def keep_one_row(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """Exactly one row of each group, with all its columns: of the least id, rows without an id last; rows without words all stay.

    Of texts of one id the one of the least hash stays, of repeated rows the one whose columns have the least hash.
    """
    base, _, roots = _grouped(docs, doc_id, text, k, percent)
    worded = base.where("n_shingles > 0")
    best = worded.groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "ref")).alias("best"))
    chosen = best.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("best").alias("best")).select(F.col("best.ref").alias("ref"))
    rows = worded.groupBy("ref").agg(F.count("*").alias("n")).join(chosen.withColumn("chosen", F.lit(True)), "ref", "left")
    rows = written(rows.where("chosen is null or n > 1").select("ref", F.col("chosen").isNotNull().alias("chosen")))
    own = docs.select(in_row(docs), _ref(doc_id, text))
    again = own.join(rows.where("chosen"), "ref", "left_semi").groupBy("ref").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return own.join(rows, "ref", "left_anti").select("row").unionByName(again.select("row")).select(*from_row(docs.columns))

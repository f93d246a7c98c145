"""WARC archives with a two-level capture index.

`write` puts one record per page into gzip-per-record .warc.gz files in the shared folder. Of pages with equal payloads
of at least `min_revisit_bytes`, the one of the largest id is the response; the others are revisits that refer to it and
carry no payload. Captures are then sorted by reversed-host URL key and id: sampled splitters range-partition them, each
partition is one index file of compressed blocks of `block_rows` lines, and a sparse directory holds the first key, file,
offset and length of each block. `lookup` sends a key to its index file by the files' first keys (as many as
partitions, so bounded), binary-searches the file's directory, reads and unpacks that block's byte range alone, and
binary-searches its lines; `read` then reads each record's byte range.

Files are named by the task's attempt and only those count that the written tables name, so a lost executor's leftovers
are never read. The folder may be anywhere that pyarrow's file systems reach and all executors share.

Defined results: a very long payload is one record, in the hands of one task; null payloads are empty, null URLs have the empty key; repeated rows are written and found one by one
(lookups give each stored capture once per query row that asks for its key and id); of equal payloads and equal ids each
row is a response; empty tables make an archive without files; extra columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import parallelism, shared_dir, slices, written
from .url_rules import host_of, reversed_host

_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SALTS = 16


def url_key(url: Column) -> Column:
    """Reversed host, a closing bracket, then path and query as they are, without fragment."""
    rest = F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^#]*)", 1)
    return F.coalesce(F.concat(reversed_host(host_of(url)), F.lit(")"), rest), F.lit(""))


def _record_id(page_id: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page/{page_id}')}>"


def record(page_id: object, url: str | None, payload: bytes, digest: str, size: int, refers_to: object, date: str) -> bytes:
    """One WARC/1.1 record; refers_to: the response's page of a revisit, else None."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    sha = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {date}", f"WARC-Target-URI: {'' if url is None else ' '.join(url.split())}", f"WARC-Payload-Digest: sha1:{sha}", f"X-Page-ID: {page_id}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
        payload = b""
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(head) + len(payload)}", "", ""]
    return "\r\n".join(lines).encode() + head + payload + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC header, HTTP header and payload of one unpacked record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(warc["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def _gzip(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _files(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class _Reader:
    """Byte ranges of files; keeps a few open."""

    def __init__(self, folder: str):
        self.fs, self.root = _files(folder)
        self.open: dict[str, pa.NativeFile] = {}

    def range(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.open:
            if len(self.open) >= 16:
                self.open.pop(next(iter(self.open))).close()
            self.open[name] = self.fs.open_input_file(f"{self.root}/{name}")
        return self.open[name].read_at(length, offset)


class _Writer:
    """Appends to a file of this task's own, and starts another beyond `most` bytes."""

    def __init__(self, folder: str, kind: str, ending: str, most: int):
        self.fs, self.root = _files(folder)
        self.kind, self.ending, self.most = kind, ending, most
        self.sink, self.at, self.name = None, 0, ""

    def append(self, data: bytes) -> tuple[str, int]:
        if self.sink is None or self.at >= self.most:
            self.close()
            self.name, self.at = f"{self.kind}-{uuid.uuid4().hex}{self.ending}", 0
            self.fs.create_dir(self.root, recursive=True)
            self.sink = self.fs.open_output_stream(f"{self.root}/{self.name}", compression=None)
        where = self.name, self.at
        self.sink.write(data)
        self.at += len(data)
        return where

    def close(self) -> None:
        if self.sink is not None:
            self.sink.close()
            self.sink = None


@dataclass
class Archive:
    """A folder of archives, its captures' index files, and their directory (part, key, id, file, offset, length)."""

    folder: str
    directory: DataFrame
    #: (first key, first id) of each part, in order
    heads: list[tuple[str, int]]


def write(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", folder: str | None = None, min_revisit_bytes: int = 1000, block_rows: int = 3000, level: int = 1, date: str = "2026-01-01T00:00:00Z", most: int = 1 << 28) -> Archive:
    spark = pages.sparkSession
    folder = folder or shared_dir(spark)
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(F.col(page_id).cast("bigint").alias("id"), F.col(url).alias("url"), body.alias("body"))
    rows = rows.select("id", "url", "body", F.octet_length("body").alias("size"), F.sha1("body").alias("digest"), url_key(F.col("url")).alias("key"))
    twins = rows.where(F.col("size") >= min_revisit_bytes).groupBy("digest").agg(F.max("id").alias("best"), F.count("*").alias("n")).where("n > 1").select("digest", "best")
    linked = rows.join(twins, "digest", "left").select("id", "key", "url", "size", "digest", F.when(F.col("id") == F.col("best"), None).otherwise(F.col("best")).alias("refers_to"), F.when(F.col("best").isNull() | (F.col("id") == F.col("best")), F.col("body")).alias("body"))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Writer(folder, "archive", ".warc.gz", most)
        for batch in slices(batches, 512):
            files, offsets, lengths = [], [], []
            for id_, where, size, digest, refers, text in zip(*(batch.column(c) for c in ("id", "url", "size", "digest", "refers_to", "body")), strict=True):
                body = (text.as_py() or "").encode()
                packed = _gzip(record(id_.as_py(), where.as_py(), body, digest.as_py(), size.as_py(), refers.as_py(), date), level)
                file, at = out.append(packed)
                files.append(file)
                offsets.append(at)
                lengths.append(len(packed))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("id"), pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], names=["key", "id", "file", "offset", "length"])
        out.close()

    shape = "key string, id bigint, file string, offset bigint, length bigint"
    captures = written(linked.mapInArrow(store, shape))
    n = parallelism(spark)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Writer(folder, "index", ".cdx.gz", 1 << 62)
        lines: list[tuple] = []
        part = uuid.uuid4().hex

        def flush() -> pa.RecordBatch:
            text = "\n".join("\t".join(map(str, (k.replace("\t", "%09").replace("\n", "%0A"), *rest))) for k, *rest in lines)
            packed = zlib.compress(text.encode())
            file, at = out.append(packed)
            made = pa.RecordBatch.from_pydict({"part": [part], "key": [lines[0][0]], "id": pa.array([lines[0][1]], pa.int64()), "file": [file], "offset": [at], "length": [len(packed)]})
            lines.clear()
            return made

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "file", "offset", "length")), strict=True):
                lines.append((row[0].replace("\t", "%09").replace("\n", "%0A"), -1 if row[1] is None else row[1], *row[2:]))
                if len(lines) == block_rows:
                    yield flush()
        if lines:
            yield flush()
        out.close()

    safe = F.regexp_replace(F.regexp_replace("key", "\t", "%09"), "\n", "%0A").alias("key")
    sorted_ = captures.select(safe, F.coalesce("id", F.lit(-1)).alias("id"), "file", "offset", "length").repartitionByRange(n, "key", "id").sortWithinPartitions("key", "id")
    directory = written(sorted_.mapInArrow(index, "part string, key string, id bigint, file string, offset bigint, length bigint"))
    heads = directory.groupBy("part").agg(F.min(F.struct("key", "id")).alias("h")).select("part", "h.*").collect()
    order = sorted((r.key, r.id, r.part) for r in heads)
    ranks = spark.createDataFrame([(p, i) for i, (_, _, p) in enumerate(order)], "part string, rank int")
    return Archive(folder, directory.join(F.broadcast(ranks), "part").drop("part").withColumnRenamed("rank", "part"), [(k, i) for k, i, _ in order])


def lookup(archive: Archive, wanted: DataFrame) -> DataFrame:
    """wanted (key, id) -> (key, id, file, offset, length) of the captures found, by binary search in the index."""
    heads, folder = archive.heads, archive.folder

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            # equal keys and ids may lie across a boundary: every part that can hold them is asked
            out = [(k, i, part) for k, i in zip(keys, ids, strict=True) for part in range(max(0, bisect_left(heads, (k, i)) - 1), bisect_right(heads, (k, i)))]
            cols = list(zip(*out, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32())], names=["key", "id", "part"])

    asked = wanted.mapInArrow(route, "key string, id bigint, part int").withColumn("salt", F.pmod(F.xxhash64("key", "id"), F.lit(_SALTS)).cast("int"))
    blocks = archive.directory.withColumn("salt", F.explode(F.array(*(F.lit(i) for i in range(_SALTS)))))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        reader = _Reader(folder)
        blocks = sorted(zip(*(right.column(c).to_pylist() for c in ("key", "id", "file", "offset", "length")), strict=True))
        first = [b[:2] for b in blocks]
        held, lines, keys = -1, [], []
        out = []
        for want in sorted(zip(left.column("key").to_pylist(), left.column("id").to_pylist(), strict=True)):
            for b in range(max(0, bisect_left(first, want) - 1), bisect_right(first, want)):
                if b != held:
                    held, lines = b, [x.split("\t") for x in zlib.decompress(reader.range(*blocks[b][2:])).decode().split("\n")]
                    keys = [(x[0], int(x[1])) for x in lines]
                for x in lines[bisect_left(keys, want) : bisect_right(keys, want)]:
                    out.append((x[0], int(x[1]), x[2], int(x[3]), int(x[4])))
        cols = list(zip(*out, strict=True)) or [[]] * 5
        return pa.table({"key": pa.array(cols[0], pa.string()), "id": pa.array(cols[1], pa.int64()), "file": pa.array(cols[2], pa.string()), "offset": pa.array(cols[3], pa.int64()), "length": pa.array(cols[4], pa.int64())})

    return asked.groupBy("part", "salt").cogroup(blocks.groupBy("part", "salt")).applyInArrow(search, "key string, id bigint, file string, offset bigint, length bigint")


def wanted_of(pages: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """The index keys of these pages, each once."""
    key = F.regexp_replace(F.regexp_replace(url_key(F.col(url)), "\t", "%09"), "\n", "%0A")
    return pages.select(key.alias("key"), F.coalesce(F.col(page_id).cast("bigint"), F.lit(-1)).alias("id")).distinct()


def read(archive: Archive, captures: DataFrame) -> DataFrame:
    """captures (file, offset, length) -> page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload.

    A response's digest is computed from the payload read, and must be the one that its header states.
    """
    folder = archive.folder

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(folder)
        for batch in slices(batches, 512):  # few payloads in hand at a time
            rows = []
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                warc, http, payload = parse(zlib.decompress(reader.range(file, offset, length), 31))
                digest = base64.b32decode(warc["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                kind = warc["WARC-Type"]
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"{file} at {offset}: the payload is not the one that was stored")
                refers = warc.get("X-Refers-To-Page-ID")
                page = warc["X-Page-ID"]
                rows.append((None if page == "None" else int(page), int(http["Content-Length"]), digest, kind, refers and int(refers), warc["WARC-Target-URI"], payload if kind == "response" else None))
            cols = list(zip(*rows, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()), strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])

    # few ranges of a file together, in the file's order
    near = captures.withColumn("stretch", F.floor(F.col("offset") / (1 << 22))).repartition(parallelism(captures.sparkSession), "file", "stretch").sortWithinPartitions("file", "offset")
    return near.select("file", "offset", "length").mapInArrow(load, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, payload binary")

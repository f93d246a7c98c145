"""SentencePiece encoding and decoding by batched numpy Viterbi over a tokenizer model's pieces.

See `unigram` for scores, pre-tokens and spelling. Equal-length words advance together; substring hashes probe the
sorted piece keys; maxima over the last piece's length are vectorised and store backpointers. The vocabulary (bounded:
a model's pieces) is read on the driver and broadcast; each document is encoded by itself, so nothing is shuffled.

Defined results: very long texts are encoded whole, very long words stretch by stretch; null and empty texts have no ids; null ids decode to null; every text decodes to itself, a lone
surrogate excepted, which Spark strings can't hold; equal sums prefer the longest last piece; repeated rows are
encoded alike; empty tables give empty results; extra columns pass through untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import fields, from_row, in_row, shape, slices
from .unigram import Encoder, Pieces

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _encoded(encoder: Encoder, texts: pa.Array) -> pa.ListArray:
    flat, sizes = encoder.encode(texts.to_pylist())
    return pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), pa.array(flat, pa.int32()))


def _decoded(pieces: pa.Array, lists: pa.ListArray) -> list[str | None]:
    """The texts that lists of ids spell; null for null."""
    spelt = pieces.take(lists.flatten())
    ends = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
    at = np.frombuffer(spelt.buffers()[1], np.int32, len(spelt) + 1, spelt.offset * 4)[ends]
    data = spelt.buffers()[2]
    data = data.to_pybytes() if data is not None else b""
    # the implied space goes
    return [None if lost else data[a + 1 : b].decode("utf-8", "replace") for a, b, lost in zip(at[:-1].tolist(), at[1:].tolist(), lists.is_null().to_pylist(), strict=True)]


def _rows(frame: DataFrame, value: str, name: str) -> DataFrame:
    return frame.select(in_row(frame), F.col(value).alias(name))


def encode(docs: DataFrame, text: str = "text", ids: str = "input_ids", model: str = MODEL) -> DataFrame:
    """The documents with one more column, the array of piece ids."""
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(model))
    frame = _rows(docs, text, "t").withColumn("t", F.col("t").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), _encoded(encoder, part.column(1))], names=["row", "ids"])

    out = frame.mapInArrow(run, shape(("row", frame.schema["row"].dataType), *fields("ids array<int>")))
    return out.select(*from_row(docs.columns), F.col("ids").alias(ids))


def decode(encoded: DataFrame, ids: str = "input_ids", text: str = "decoded", model: str = MODEL) -> DataFrame:
    """The rows with one more column, the text that the ids spell."""
    shared = encoded.sparkSession.sparkContext.broadcast(Pieces(model).bytes)
    frame = _rows(encoded, ids, "i")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(shared.value, pa.binary())
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_decoded(pieces, part.column(1)), pa.string())], names=["row", "t"])

    out = frame.mapInArrow(run, shape(("row", frame.schema["row"].dataType), *fields("t string")))
    return out.select(*from_row(encoded.columns), F.col("t").alias(text))


def recode(docs: DataFrame, text: str = "text", ids: str = "input_ids", decoded: str = "decoded", model: str = MODEL) -> DataFrame:
    """Both in one pass over the rows: the array of piece ids, and the text that these ids spell in its turn."""
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(model))
    frame = _rows(docs, text, "t").withColumn("t", F.col("t").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pieces = Encoder(shared.value), pa.array(shared.value.bytes, pa.binary())
        for part in slices(batches):
            lists = _encoded(encoder, part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(_decoded(pieces, lists), pa.string())], names=["row", "ids", "t"])

    out = frame.mapInArrow(run, shape(("row", frame.schema["row"].dataType), *fields("ids array<int>, t string")))
    return out.select(*from_row(docs.columns), F.col("ids").alias(ids), F.col("t").alias(decoded))


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """Per document: n_tokens, ids_sha256 (of the ids as little-endian int32), round_trip (decoding gives the text)."""
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(model))
    frame = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("t"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pieces = Encoder(shared.value), pa.array(shared.value.bytes, pa.binary())
        for part in slices(batches):
            lists = _encoded(encoder, part.column(1))
            flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            hashes = [hashlib.sha256(flat[a:b].astype("<i4").tobytes()).hexdigest() for a, b in zip(ends, ends[1:], strict=False)]
            same = [(t or "") == back for t, back in zip(part.column(1).to_pylist(), _decoded(pieces, lists), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(ends).astype(np.int64)), pa.array(hashes, pa.string()), pa.array(same, pa.bool_())], names=["id", "n_tokens", "ids_sha256", "round_trip"])

    out = frame.mapInArrow(sums, shape(("id", docs.schema[doc_id].dataType), *fields("n_tokens bigint, ids_sha256 string, round_trip boolean")))
    return out.withColumnRenamed("id", doc_id)

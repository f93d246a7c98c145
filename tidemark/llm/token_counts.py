"""Token counts by dynamic programming over a trie of the distinct pre-tokens.

Scores, pre-tokens and spelling are the encoder's (see `unigram`), so counts equal the lengths of its id lists. The
distinct pre-tokens of a block of documents are sorted into a trie; a node's forward score is computed once for all
words that share the prefix, level by level; a word's count stands at its terminal node. Blocks and the words kept
between them are bounded; each document is counted by itself, so nothing is shuffled.

Defined results: very long texts are counted whole, very long words stretch by stretch; null and empty texts have 0 tokens; ties of scores have equal counts; repeated rows are counted
alike; empty tables give empty results; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import fields, shape, slices
from .piece_codec import MODEL
from .unigram import Counter, Pieces


def count_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """Per document: its id, n_tokens, n_pre_tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for part in slices(batches):
            tokens, words = counter.counts(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(tokens, pa.int64()), pa.array(words, pa.int64())], names=["id", "n_tokens", "n_pre_tokens"])

    frame = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("t"))
    out = frame.mapInArrow(run, shape(("id", docs.schema[doc_id].dataType), *fields("n_tokens bigint, n_pre_tokens bigint")))
    return out.withColumnRenamed("id", doc_id)

"""The corpus pipeline: five operators in turn, each stage's result written as Parquet and read as the next one's documents.

Null and empty texts go with the quality rules; documents emptied by a stage go with it; of repeated rows one stays, and
texts of one id and rows without an id are judged on their own; an empty table gives an empty result; columns beyond
those of documents are carried to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_crf, minhash, piece_codec, suffix_dedup
from tidemark.llm._common import discard, table, written


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars follows the text where there is such a column."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose lines are mostly content."""
    return line_crf.keep_content(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, whatever its id: five-word shingles, similarity 0.8."""
    return minhash.keep_one_row(docs, k=5, percent=80)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of over 50 words, or of 400 bytes and more, that occur more than once."""
    return _measured(suffix_dedup.without_repeats(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those that are little else go."""
    return _measured(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, input_ids, and the text that they decode to."""
    coded = piece_codec.recode(docs.select("doc_id", "text"))
    return coded.select("doc_id", F.size("input_ids").cast("bigint").alias("n_tokens"), "input_ids", F.col("decoded").alias("text"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("passage_dedup", passage_dedup), ("benchmark_decontamination", benchmark_decontamination), ("pieces", pieces)]

#: SQL cannot express the first stage; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir))
        discard(before)  # the given table is none of those that `written` made, and stays
    return STAGES[-1][1](spark, docs, sf_dir)

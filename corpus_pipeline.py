"""Corpus pipeline over ``documents``: quality, line dedup, near-dedup, substring dedup, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given; all but the last return
the columns of documents.  Between stages the rows are written as Parquet in the shared checkpoint
folder and read again.

Defined cases are those of the operators: null texts count as empty; rows equal in id and text are
the same document given more than once and fare alike; an empty table gives empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volcast.llm import line_dedup, lsh_forest, pairwise_quality, seed_extend
from volcast.llm.common import table, with_rest, written
from volcast.llm.harmonic_packing import pack
from volcast.llm.queries import tokenizer_path

#: Similarity (percent of five-word shingles) from which the stage links two documents; 85 is op4's own contract.
NEAR_PERCENT = 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Bradley-Terry model of the training folds accepts."""
    model = pairwise_quality.fit(docs, table(spark, sf_dir, "labels"))
    return pairwise_quality.accepted(docs, model)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more of them share (but in the largest id)."""
    return with_rest(line_dedup.line_dedup(docs, carry=True), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of every component of near duplicates of similarity ``NEAR_PERCENT`` or more."""
    kept = (lsh_forest.near_duplicates(spark, docs, percent=NEAR_PERCENT).where("kept")
            .select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).distinct())
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id"))
                     & (F.xxhash64("text") == F.col("kept_hash")), "left_semi")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated 20-word passages (but the first occurrence)."""
    return with_rest(seed_extend.substring_dedup(spark, docs, carry=True), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 tokens."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", drop_shared_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack_sequences),
]

#: The classifier, the tokeniser and the packing are not SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

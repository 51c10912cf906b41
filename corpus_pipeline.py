"""From raw documents to sampled training pieces: five stages, each written and read again.

1 quality classifier: documents it rejects go. 2 exact dedup: one row of each group of equal texts stays.
3 MinHash near-dedup: one document of each group of near copies stays. 4 mixing: each document is
repeated as often as the target weights of its source ask for. 5 SentencePiece encoding: the
sampled pieces of every row, which decode to its text.

A stage works on all that its predecessor kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import exact_dedup, mixing, near_dedup, pieces, quality_model
from shelfline.llm.common import cut_lineage, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, pieces, and text_sha256 of the text that the pieces decode to."""
    return pieces.sampled_pieces(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

# Trained trees, sketches and sampling are not SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

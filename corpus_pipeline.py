"""A training corpus from the documents: five stages, each on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm import exact_dedup, mixing, near_dedup, piece_codec, quality
from loamline.llm.shared import dealt, scratch_uri

PIECES = "piece_bpe_32k.model"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and lie near their language's distributions."""
    return quality.good_documents(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal text."""
    return exact_dedup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a shingle similarity of 0.8."""
    return near_dedup.deduplicate(docs, threshold=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every draw of the mix is a row, so documents repeat or go."""
    return mixing.mix(docs).select(*docs.columns)


def texts_together(docs: DataFrame) -> DataFrame:
    """doc_id and text, with the draws of a text side by side, where the codec codes them once.

    The mix draws a document at most twice, so no task gets many rows of one text.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("place"))
    return dealt(rows, "place").sortWithinPartitions("place")


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of each row, as digests."""
    return piece_codec.digests(texts_together(docs), public_tokenizers.path(PIECES)).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("mixing sources to target weights", source_mix),
    ("SentencePiece encoding and decoding", piece_encoding),
]

# Minima of hashes, pseudo-random places and piece encoding have no SQL form; the tests
# compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        uri = scratch_uri(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(uri)
        docs = spark.read.parquet(uri)
    return docs

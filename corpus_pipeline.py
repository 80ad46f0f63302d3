"""The corpus pipeline: five operators in a row, each over all that the one before it kept.

Each stage takes the session, the documents so far and the folder of the tables, and returns a DataFrame that
is written as Parquet and read again for the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.common import materialize
from quern.llm import decontaminate, jaccard_join, piece_sampling, substring_dedup, toxicity
from quern.llm.queries_scan import CATEGORIES, chain_labels

# Near copies: sets of five-word shingles that are alike by 80 % or more.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the classifier chain, fitted on the labelled documents, finds toxic."""
    labels = chain_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject_toxic(docs, toxicity.fit_chain(docs, labels, CATEGORIES))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest number of each group of near copies, and one row of it."""
    return jaccard_join.drop_near_duplicates(docs, NEAR_PERCENT, NEAR_SHINGLE)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut runs of 35 words that occur twice out of the texts and count their characters again."""
    cut = substring_dedup.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sampled segmentation of each document."""
    encoded = piece_sampling.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids")


STAGES = [
    ("toxicity", reject_toxic),
    ("near_copies", drop_near_copies),
    ("repeated_passages", cut_repeats),
    ("decontamination", drop_contaminated),
    ("pieces", encode_pieces),
]

# A trained model decides the first stage, which SQL cannot express; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs

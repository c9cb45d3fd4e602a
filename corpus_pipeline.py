"""Documents to training tokens: filter, deduplicate, decontaminate, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents. All stages but the
last return the columns of documents. Models are learned from the labels of the
stage's own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtide.llm import bpe, decontamination, quality_ranking, simhash, toxicity
from subtide.llm.frames import table
from subtide.llm.queries import TOKENIZER, ids_digest
from subtide.session import materialized

SHINGLE_WORDS, MAX_BITS = 4, 4
WINDOW_WORDS = 13


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking rejects go."""
    return quality_ranking.drop_low_quality(docs, quality_ranking.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id."""
    return simhash.drop_near_duplicates(docs, SHINGLE_WORDS, MAX_BITS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark windows go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), WINDOW_WORDS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of the decoded text."""
    return bpe.encode_documents(docs, TOKENIZER, keep=["doc_id"], decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        ids_digest("ids").alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: Trained models and hash fingerprints are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again.

    Null texts count as empty; a null id is an id like any other. Of equal and
    repeated rows one stays. Extra columns reach every stage but the last, names
    that clash with its results included. Without labels both classifiers keep all, without
    a benchmark nothing is contaminated, and an empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir), name)
    return docs

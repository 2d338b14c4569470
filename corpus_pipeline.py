"""A corpus pipeline over `documents`: each stage works on all that the one before it kept.

The stages: documents that the quality classifier rejects go; of equal texts the one with the smallest id stays, and of
each group of near-duplicates likewise; documents into which a benchmark item leaks go; the rest is tokenised. All but
the last return the columns of `documents`; nulls, repeated rows and empty tables are as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywire.llm import decontaminate, exact, minhash, quality, subwords
from tallywire.llm.common import ship, stage, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least the threshold of the classifier, trained on the labels."""
    ship(spark)
    return quality.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id."""
    ship(spark)
    return exact.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    ship(spark)
    return minhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    ship(spark)
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids of the pieces, their number, and whether they decode to the text."""
    ship(spark)
    found = subwords.encode(docs)
    return found.select(F.col("id").alias("doc_id"), "ids", F.size("ids").cast("long").alias("n_tokens"), "round_trip")


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", tokenise),
]

# Scoring and tokenising cannot be written in SQL; tests/llm holds the result against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages; what each stage keeps is stored in the shared folder and read again by the next."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

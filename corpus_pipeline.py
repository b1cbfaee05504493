"""Corpus pipeline: from raw documents to packed training sequences, each stage one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result
as Parquet under spark.checkpoint.dir and reads it back as the next stage's documents.
All stages but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm import jaccard, mixing, packing, secret_scan, toxicity
from forgelake.llm.common import free, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score lies below the threshold stay."""
    score = free("__score", docs)
    scored = toxicity.scored(docs, table(spark, sf_dir, "labels"), into=score)
    return scored.filter(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, Jaccard 0.8 or more) stays."""
    return jaccard.deduplicated(docs, k=5, share=(80, 100))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out as the sources' target weights ask."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    return packing.digested(packing.pack(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

#: Tokenizing and the trained classifier cannot be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

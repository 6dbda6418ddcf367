"""From raw documents to training tokens: toxic ones out, copies out, sources mixed, texts encoded.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as
the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartflow.llm import exact_dedup, mixing, near_dedup, piece_codec, toxicity
from cartflow.llm.common import documents, labels, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a model trained on their labels outside the held-out fold."""
    return toxicity.without_toxic(docs, toxicity.train(docs, labels(spark, sf_dir)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts, the one with the largest id."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each class of near-duplicates, the one with the least id."""
    return near_dedup.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that every source has the same share, in random order."""
    return mixing.poisson_mixture(docs).select(*[f"`{c}`" for c in docs.columns])


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and lang with the piece ids, their score, and the N-best segmentations."""
    return piece_codec.encode(docs, keep=["doc_id", "source", "lang"])


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

# Training a model and verifying near-duplicates are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

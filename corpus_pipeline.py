"""A corpus pipeline of five operators, each stage written and read again as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm import exact_dedup, mixing, segment_sampling, simhash, toxicity
from tidegate.llm.store import stored, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned from the labels, does not call toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model, threshold=0.7)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal without white space."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near fingerprints."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them, each copy with its number."""
    return mixing.mixed_documents(docs, weights=(3, 1, 2), share=1.5, most=2.0, numbered=True)


def encode_samples(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of one sampled segmentation of each copy of a document, drawn without replacement among its copies.

    A document with fewer segmentations than copies begins again with its first.
    """
    once = docs.filter("copy = 1")
    return segment_sampling.sampled(once, public_tokenizers.path("piece_bpe_32k.model"), k=F.col("copies"), again=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode_samples),
]

#: A learned model and sampling with seeded noise are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

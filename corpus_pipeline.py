"""A training corpus from ``documents``: each stage works on all that the one before kept.

All stages but the last return the columns of their input, whatever else is among them.  Null and empty texts are scored as
texts without hits, are equal to each other (one stays), are sampled with the cell they belong to and packed as the end id
alone; a row without doc_id takes part everywhere, stays of a group only if no row of it has an id, and shares its draw with
other such rows; of repeated rows one stays; very long texts are used whole.  Without labels every document has the same low
score and stays.  Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from noisetrack.llm import exact_dedup, mixing, packing, simhash_dedup, toxicity
from noisetrack.llm.common import kept, read, scratch


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    return toxicity.reject_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return exact_dedup.drop_duplicates(docs, keep="max")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts the smallest doc_id stays."""
    return simhash_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn by calibrated probabilities."""
    return mixing.sample_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", reject_toxic), ("exact_dedup", exact_duplicates), ("near_dedup", near_duplicates), ("mixing", mix_sources), ("packing", pack)]

#: The stages on learned scores, fingerprints and token ids can't be put in SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark):  # what a stage stored on its way goes when its result is written
            docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

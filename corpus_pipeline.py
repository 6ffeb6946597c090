"""The corpus pipeline: five stages over documents, each written as Parquet before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from truegrain.llm import exact_dedup, mixing, packing, quality, simhash
from truegrain.llm.common import Scratch, cleared_after


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; it learns from the labels beside the documents."""
    return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that fingerprints at two or fewer differing bits link, the document with the smallest doc_id."""
    return simhash.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in one row a time."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per token piece, with its sequence and place; a document taken twice is packed twice."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", classify),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("mixing", mix),
    ("best_fit_packing", pack),
]

#: Trained scores, hashes of shingles and token ids have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each stage's rows are stored and read again.

    A stage's own steps are removed once its rows are stored, and its rows once those of the next stage are.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        kept = Scratch(spark, f"pipeline-{name}")
        with cleared_after():
            docs = kept.store(stage(spark, docs, sf_dir))
        if before:
            before.clear()
        before = kept
    return docs

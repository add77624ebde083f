"""The training-data pipeline: five stages from raw documents to sampled token sequences.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before
kept, and its decisions take effect: rejected documents, near duplicates but one
of each group and documents with benchmark items go, credentials are masked. All
stages but the last return the columns of ``documents``.

Rows with a null id stay in all filtering stages but the first, which judges their
texts as any others; null and empty texts are judged as texts without words, are no near
duplicates and hold no benchmark item; equal rows count as one document; an empty
table stays empty; further columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxmill.llm import decontam, near_dup, quality, sampling, secrets
from voxmill.llm.runtime import store
from voxmill.session import ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose Bradley-Terry score reaches the threshold learned from ``labels``.

    Null texts, ties and repeated rows are as in ``quality.judged``; without labels of both kinds all stay.
    """
    ship(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group: the one with the smallest id; of equal rows one.

    Null, empty and word-less texts and rows with a null id stay.
    """
    ship(spark)
    return near_dup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no item of ``benchmark``; null and empty texts and rows with a null id stay."""
    ship(spark)
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces credentials in the texts by the names of their formats; all documents stay, null and empty texts as they are."""
    ship(spark)
    return secrets.mask_secrets(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Distinct sampled segmentations of each text, with inclusion scores; a null or empty text has the one empty segmentation."""
    ship(spark)
    return sampling.sample_segmentations(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scan", secrets_stage),
    ("sentencepiece_sampling", encoding_stage),
]

#: SQL cannot express the stages; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs, _ = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

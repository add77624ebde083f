"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, lm_score, media, near_dup, passages, quality, sampling, secrets, token_counts, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_media_tiles": media.query,
        "op2_warc_index_merge": warc.query,
        "op3_substring_dedup": passages.query,
        "op4_benchmark_decontamination": decontam.query,
        "op5_quality_classifier": quality.query,
        "op6_secret_scan": secrets.query,
        "op7_lm_pseudo_likelihood": lm_score.query,
        "op8_minhash_near_dedup": near_dup.query,
        "op9_token_counts": token_counts.query,
        "op10_sentencepiece_sampling": sampling.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_warc_index_merge": warc.ORACLE_SQL}

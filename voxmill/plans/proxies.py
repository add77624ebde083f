"""Stand-ins for the speech tables made from the driver's tables, in Spark and as DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.ids import segment_id
from ..materialize import spread

_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as segments: an order is a recording, the quantity the duration, scores come from price, discount and tax.

    Rows lie together by recording. What is computed from them comes after the window, so that
    branches of one plan with the same columns of lineitem share its exchange.
    """
    rows = table(spark, sf_dir, "lineitem")
    rows = spread(rows.withColumn("audio_id", F.col("l_orderkey").cast("string")), rows.count(), "audio_id")
    idx = (F.row_number().over(Window.partitionBy("audio_id").orderBy(*_ORDER)) - 1).cast("bigint")
    rows = rows.withColumn("seg_idx", idx).select(
        "audio_id", "seg_idx", F.col("l_quantity").alias("duration_sec"),
        (F.lit(1.0) + (F.round(F.col("l_extendedprice") * 100).cast("bigint") % 4001) / F.lit(1000.0)).alias("mos_ovr"),
        (F.lit(1.0) + F.col("l_discount") * 40).alias("mos_sig"), (F.lit(1.0) + F.col("l_tax") * 50).alias("mos_bak"),
    )
    start = (F.col("seg_idx") * 60).cast("double")
    return rows.select(
        segment_id(F.col("audio_id"), F.col("seg_idx")).alias("seg_id"), "audio_id", F.concat(F.lit("/data/"), "audio_id", F.lit(".wav")).alias("path"), "seg_idx",
        start.alias("start_sec"), (start + F.col("duration_sec")).alias("end_sec"), "duration_sec", "mos_ovr", "mos_sig", "mos_bak",
    )


SEGMENTS = f"""raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS audio_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(_ORDER)}) - 1 AS seg_idx,
         l_quantity AS duration_sec, 1.0::DOUBLE + (CAST(round(l_extendedprice * 100) AS BIGINT) % 4001) / 1000.0::DOUBLE AS mos_ovr,
         1.0::DOUBLE + l_discount * 40 AS mos_sig, 1.0::DOUBLE + l_tax * 50 AS mos_bak
  FROM lineitem
), segments AS (
  SELECT printf('%s_seg%03d', audio_id, seg_idx) AS seg_id, audio_id, '/data/' || audio_id || '.wav' AS path, seg_idx,
         CAST(seg_idx * 60 AS DOUBLE) AS start_sec, CAST(seg_idx * 60 AS DOUBLE) + duration_sec AS end_sec, duration_sec, mos_ovr, mos_sig, mos_bak
  FROM raw
)"""


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as transcribed utterances: a source is a recording, 100 characters a second."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id", F.col("source").alias("audio_id"), F.col("text"), F.when(F.col("doc_id") % 37 != 0, F.col("lang")).alias("lang"), (F.col("n_chars") / F.lit(100.0)).alias("duration_sec"),
        ((F.col("n_chars") % 1000) / F.lit(1000.0)).alias("lang_prob"), F.when(F.col("doc_id") % 11 != 0, F.concat(F.lit("/wav/"), F.col("doc_id").cast("string"), F.lit(".wav"))).alias("wav"),
        F.when(F.col("doc_id") % 13 != 0, F.lit(1.0) + (F.col("n_chars") % 401) / F.lit(100.0)).alias("mos_ovr"),
    )


UTTERANCES = """utterances AS (
  SELECT doc_id, source AS audio_id, text, CASE WHEN doc_id % 37 <> 0 THEN lang END AS lang, n_chars / 100.0::DOUBLE AS duration_sec, (n_chars % 1000) / 1000.0::DOUBLE AS lang_prob,
         CASE WHEN doc_id % 11 <> 0 THEN '/wav/' || doc_id || '.wav' END AS wav, CASE WHEN doc_id % 13 <> 0 THEN 1.0::DOUBLE + (n_chars % 401) / 100.0::DOUBLE END AS mos_ovr
  FROM documents
)"""

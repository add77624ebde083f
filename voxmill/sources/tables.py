"""Hand-over files between stages: JSON arrays, TSV, JSON lines with damaged rows, shard files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VAD_JSON = "audio_id string, path string, num_segments int, segments array<struct<start_sec: double, end_sec: double, duration_sec: double>>, error string"


def json_array(spark: SparkSession, path: str, schema: str = VAD_JSON) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def tsv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A tab-separated file with a header, all columns strings."""
    return spark.read.csv(path, sep="\t", header=True, quote="")


def json_lines(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Records of a checkpoint; lines that are no such record are skipped."""
    return spark.read.schema(schema).json(path, mode="DROPMALFORMED")


def score_shards(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All shard files, read together, with ``file``, ``block`` and ``line`` in whose order the last row wins; files whose headers differ are an error."""
    if not paths:
        raise ValueError("no shard files")
    heads = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")).where("start = 0")
    first = heads.groupBy("path").agg(F.first("value").alias("head")).groupBy("head").agg(F.min("path").alias("path")).limit(2).collect()
    if len(first) > 1:
        raise ValueError(f"{first[0].path} has the columns {first[0]['head']!r}, {first[1].path} has {first[1]['head']!r}")
    rows = tsv(spark, paths)
    return rows.withColumns({"file": F.col("_metadata.file_path"), "block": F.col("_metadata.file_block_start"), "line": F.monotonically_increasing_id()})

"""Sinks: JSON arrays, TSV with a header even when empty, pairs of outputs, clips, training files."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .materialize import exists


def write_json_array(df: DataFrame, path: str) -> int:
    """One file with a pretty JSON array in the table's order, nulls left out; rows stream through the driver one partition at a time."""
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for line in df.select(F.to_json(F.struct(*df.columns))).toLocalIterator():
            f.write(("," if n else "") + "\n  " + json.dumps(json.loads(line[0]), ensure_ascii=False))
            n += 1
        f.write("\n]\n" if n else "]\n")
    return n


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated text with a header; an empty table gives a file with the header alone."""
    if df.isEmpty():
        head = df.sparkSession.createDataFrame([("\t".join(df.columns),)], "value string")
        head.coalesce(1).write.mode(mode).text(path)
    else:
        df.write.mode(mode).csv(path, sep="\t", header=True, quote="", emptyValue="")


def write_both(df: DataFrame, keep: Column, all_path: str, kept_path: str, mode: str = "overwrite") -> None:
    """All scored rows and those kept, computed once."""
    df.write.mode(mode).parquet(all_path)
    df.sparkSession.read.parquet(all_path).where(keep).write.mode(mode).parquet(kept_path)


def write_once(df: DataFrame, path: str, force: bool = False) -> DataFrame:
    """A stage's output, not written again where a complete one exists, unless forced; a folder without its success mark is incomplete."""
    if force or not exists(df.sparkSession, f"{path.rstrip('/')}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_clips(clips: DataFrame, folder: str, name: str = "uid", content: str = "wav") -> DataFrame:
    """Writes each clip to ``folder``/{name}.wav on a file system all executors share; (uid, path, bytes)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Path(folder).mkdir(parents=True, exist_ok=True)
        for batch in batches:
            out = []
            for uid, wav in zip(*(c.to_pylist() for c in batch.columns)):
                path = f"{folder}/{uid}.wav"
                with open(path, "wb") as f:
                    f.write(wav)
                out.append((uid, path, len(wav)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.int64()))], names=["uid", "path", "bytes"])

    return clips.where(F.col(content).isNotNull()).select(F.col(name).cast("string"), content).mapInArrow(rows, "uid string, path string, bytes bigint")


def kept_clip_name(uuid: Column, start: Column) -> Column:
    return F.concat(F.left(uuid, F.lit(16)), F.lit("_"), F.format_string("%.3f", start))


def write_splits(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy("split").json(path)


def write_vocab(vocab: DataFrame, path: str) -> int:
    """token to id as one JSON object; the vocabulary is small by nature."""
    table = {r.token: r.id for r in vocab.orderBy("id").collect()}
    Path(path).write_text(json.dumps(table, ensure_ascii=False, indent=2), encoding="utf-8")
    return len(table)

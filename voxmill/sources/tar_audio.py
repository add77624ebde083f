"""Tar shards as a data source: one partition for each tar, members by offset, random access to single members."""

from __future__ import annotations

import glob
import hashlib
import struct
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..audio.pcm import decode_wav, resample
from .audio_files import EXTENSIONS

_META = "tar_path string, member string, wav_uuid string, wav_offset bigint, wav_size bigint, sample_rate int, duration double, num_sample bigint, error string"


class _Tar(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = sorted({p for part in options["path"].split(",") for p in glob.glob(part.removeprefix("file://"))})
        self.content = options.get("content", "false").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        return [_Tar(p) for p in self.paths]

    def read(self, partition: _Tar | None) -> Iterator[tuple]:
        if partition is None:
            return
        with tarfile.open(partition.path) as tar:
            for m in tar:
                if not m.isfile() or not m.size or m.name.rpartition(".")[2].lower() not in EXTENSIONS:
                    continue
                samples, error = None, None
                try:
                    samples = resample(*decode_wav(tar.extractfile(m).read()))
                except (ValueError, IndexError, ArithmeticError, OSError, struct.error) as e:
                    error = str(e) or type(e).__name__
                uuid = hashlib.sha256(f"{partition.path}::{m.name}".encode()).hexdigest()
                length = (16_000, len(samples) / 16_000, len(samples)) if samples is not None else (None, None, None)
                row = (partition.path, m.name, uuid, m.offset_data, m.size, *length, error)
                yield (*row, samples.astype("<f4").tobytes() if samples is not None else None) if self.content else row


class TarAudio(DataSource):
    """``spark.read.format("tar_audio").option("path", glob)``; option ``content`` adds the samples as ``pcm``.

    Members with an audio suffix and a size are listed; those that cannot be decoded, other codecs than WAV among them, have the reason in ``error``.
    """

    @classmethod
    def name(cls) -> str:
        return "tar_audio"

    def schema(self) -> str:
        return _META + (", pcm binary" if self.options.get("content", "false").lower() == "true" else "")

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def tar_audio(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    spark.dataSource.register(TarAudio)
    return spark.read.format("tar_audio").option("path", path).option("content", str(content).lower()).load()


def reread(members: DataFrame) -> DataFrame:
    """(wav_uuid, pcm, error) of rows with (wav_uuid, tar_path, wav_offset, wav_size), read again by offset; a member that fails has the reason in ``error``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uuid, path, offset, size in zip(*(c.to_pylist() for c in batch.columns)):
                pcm, error = None, None
                try:
                    with open(path, "rb") as f:
                        f.seek(offset)
                        pcm = resample(*decode_wav(f.read(size))).astype("<f4").tobytes()
                except (ValueError, IndexError, ArithmeticError, OSError, struct.error) as e:
                    error = str(e) or type(e).__name__
                yield pa.RecordBatch.from_arrays([pa.array([uuid], pa.string()), pa.array([pcm], pa.binary()), pa.array([error], pa.string())], names=["wav_uuid", "pcm", "error"])

    return members.select("wav_uuid", "tar_path", "wav_offset", "wav_size").mapInArrow(rows, "wav_uuid string, pcm binary, error string")

"""Audio files as tables: discovery, decoding, slicing; binary content stays out of exchanges."""

from __future__ import annotations

import struct
import subprocess
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..audio.pcm import cut, decode_wav, encode_wav, read_wav_span, resample, resample_polyphase
from ..functions.ids import audio_id

EXTENSIONS = ("wav", "flac", "mp3", "m4a", "ogg")
MORE_EXTENSIONS = (*EXTENSIONS, "opus")


def audio_files(spark: SparkSession, root: str, extensions: tuple[str, ...] = EXTENSIONS, flat_ids: bool = False, max_files: int | None = None, content: bool = False) -> DataFrame:
    """(audio_id, path, length[, content]) of all audio files below ``root``, whatever the case of their suffix; ``max_files`` keeps the first by path.

    Files without content are not listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    files = files.where(F.lower("path").rlike(rf"\.({'|'.join(extensions)})$"))
    out = files.select(audio_id(F.col("path"), root, flat_ids).alias("audio_id"), "path", "length", *(["content"] if content else []))
    return out.orderBy("path").limit(max_files) if max_files else out


def require_some(df: DataFrame, what: str = "input") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no {what}")
    return df


def decoded(files: DataFrame, keep: list[str], content: str = "content") -> DataFrame:
    """``keep`` columns with (pcm, duration_sec, num_sample, error): mono 16 kHz float32 bytes of each file; undecodable ones have an error."""
    kept = files.select(*keep, content)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                try:
                    x = resample(*decode_wav(batch.column(len(keep))[k].as_py() or b""))
                    out = [x.astype("<f4").tobytes(), len(x) / 16_000, len(x), None]
                except (ValueError, IndexError, ArithmeticError, OSError, struct.error) as e:
                    out = [None, None, None, str(e) or type(e).__name__]
                cols = [batch.column(c).slice(k, 1) for c in range(len(keep))]
                more = [pa.array([v], t) for v, t in zip(out, (pa.binary(), pa.float64(), pa.int64(), pa.string()))]
                yield pa.RecordBatch.from_arrays(cols + more, names=[*keep, "pcm", "duration_sec", "num_sample", "error"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes if c in keep)
    return kept.mapInArrow(rows, f"{kinds}, pcm binary, duration_sec double, num_sample bigint, error string")


def slices(segments: DataFrame, mode: str = "truncate", rate: int = 16_000) -> DataFrame:
    """(seg_id, wav): 16-bit WAV bytes of each segment of rows with (seg_id, pcm, start_sec, end_sec)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wav = [
                encode_wav(cut(np.frombuffer(pcm, "<f4"), s, e, rate, mode), rate) if pcm is not None and s is not None and e is not None else None
                for pcm, s, e in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(wav, pa.binary())], names=["seg_id", "wav"])

    return segments.select("seg_id", "pcm", F.col("start_sec").cast("double"), F.col("end_sec").cast("double")).mapInArrow(rows, "seg_id string, wav binary")


def segment_samples(segments: DataFrame) -> DataFrame:
    """(seg_id, pcm, error): mono 16 kHz samples of each segment of rows with (seg_id, path, start_sec, end_sec), read from WAV files by offset on the executors."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ident, path, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                pcm, error = None, None
                try:
                    pcm = resample_polyphase(*read_wav_span(path.removeprefix("file:"), start, end)).astype("<f4").tobytes()
                except (ValueError, TypeError, AttributeError, OSError, struct.error) as e:
                    error = str(e) or type(e).__name__
                yield pa.RecordBatch.from_arrays([pa.array([ident], pa.string()), pa.array([pcm], pa.binary()), pa.array([error], pa.string())], names=["seg_id", "pcm", "error"])

    narrow = segments.select("seg_id", "path", F.col("start_sec").cast("double"), F.col("end_sec").cast("double"))
    return narrow.mapInArrow(rows, "seg_id string, pcm binary, error string")


def transcoded(files: DataFrame, keep: list[str], content: str = "content", program: str = "ffmpeg", seconds: int = 600) -> DataFrame:
    """``keep`` columns with (wav, error): any media as mono 16 kHz 16-bit WAV bytes, by an external program on the executors.

    Content goes through pipes, so no file is written. A missing program, a
    failure or a timeout is the row's error.
    """
    kept = files.select(*keep, content)
    command = [program, "-loglevel", "error", "-i", "pipe:0", "-f", "wav", "-acodec", "pcm_s16le", "-ar", "16000", "-ac", "1", "-vn", "pipe:1"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                try:
                    done = subprocess.run(command, input=batch.column(len(keep))[k].as_py() or b"", capture_output=True, timeout=seconds)
                    wav, error = (done.stdout, None) if done.returncode == 0 else (None, done.stderr.decode(errors="replace")[:200] or f"exit {done.returncode}")
                except (OSError, subprocess.TimeoutExpired) as e:
                    wav, error = None, type(e).__name__
                cols = [batch.column(c).slice(k, 1) for c in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([wav], pa.binary()), pa.array([error], pa.string())], names=[*keep, "wav", "error"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes if c in keep)
    return kept.mapInArrow(rows, f"{kinds}, wav binary, error string")

"""Incremental arrival: segments as a stream, language decisions in keyed state, idempotent output, resume."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SEGMENT = "wav_uuid string, seg_start double, seg_end double, lang string, lang_prob double, mos_ovr double"


def segment_stream(spark: SparkSession, folder: str, schema: str = SEGMENT, files_per_trigger: int = 200) -> DataFrame:
    """New JSON-lines files of a folder; admission is bounded, damaged lines are skipped."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("mode", "DROPMALFORMED").json(folder)


def gate_stream(segments: DataFrame, targets: tuple[str, ...], min_prob: float = 0.90, keep_ms: int | None = None) -> DataFrame:
    """Segments of recordings whose first segment is in a target language (none: any) with enough probability.

    The first segment that a recording shows decides for all later ones; within
    one trigger the earliest start is first. The decision is the recording's state;
    with ``keep_ms`` it is dropped when no segment has come for so long, which bounds
    the state, and a later segment decides anew.
    """

    def one(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        pdf = pd.concat(list(frames)).sort_values("seg_start", kind="stable")
        if state.exists:
            lang, prob = state.get
        else:
            lang, prob = pdf["lang"].iloc[0], float(pdf["lang_prob"].iloc[0] or 0)
            state.update((lang, prob))
        if keep_ms is not None:
            state.setTimeoutDuration(keep_ms)
        if (not targets or lang in targets) and prob >= min_prob:
            yield pdf.assign(lang=lang, lang_prob=prob)

    return segments.groupBy("wav_uuid").applyInPandasWithState(one, segments.schema, "lang string, prob double", "append", GroupStateTimeout.NoTimeout if keep_ms is None else GroupStateTimeout.ProcessingTimeTimeout)


def gate_batch(segments: DataFrame, targets: tuple[str, ...], min_prob: float = 0.90) -> DataFrame:
    """What ``gate_stream`` gives when everything arrives at once."""
    first = segments.groupBy("wav_uuid").agg(F.min_by(F.struct("lang", "lang_prob"), "seg_start").alias("p"))
    rows = segments.drop("lang", "lang_prob").join(first, "wav_uuid").where(F.col("p.lang_prob") >= min_prob)
    if targets:
        rows = rows.where(F.col("p.lang").isin(*targets))
    return rows.select("wav_uuid", "seg_start", "seg_end", "p.lang", "p.lang_prob", "mos_ovr")


def run_available(stream: DataFrame, out: str, checkpoint: str, name: str | None = None) -> None:
    """Processes all that has arrived and ends. Each micro-batch owns one folder that a repeated attempt overwrites, so a restart neither loses nor doubles rows."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    (writer.queryName(name) if name else writer).start().awaitTermination()

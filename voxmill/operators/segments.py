"""Segments of recordings: flattening, nesting, splitting, duration gates, activity islands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.ids import segment_id
from ..functions.numbers import samples
from ..functions.text import strip


def explode_segments(nested: DataFrame) -> DataFrame:
    """One row for each segment of (audio_id, path, segments), with its 0-based ordinal and id; recordings without segments give none."""
    rows = nested.select("audio_id", "path", F.posexplode("segments").alias("seg_idx", "s"))
    return rows.select(segment_id(F.col("audio_id"), F.col("seg_idx")).alias("seg_id"), "audio_id", "path", "seg_idx", "s.*")


def nest_segments(flat: DataFrame, order: str = "seg_idx", fields: tuple[str, ...] = ("seg_id", "start_sec", "end_sec", "duration_sec")) -> DataFrame:
    """(audio_id, path, num_segments, segments) in the given order; blank ids are dropped, the path is that of the first row.

    Missing numbers are 0 and missing strings empty.
    """
    kinds = dict(flat.dtypes)
    filled = [F.coalesce(F.col(c), F.lit("") if kinds[c] == "string" else F.lit(0).cast(kinds[c])).alias(c) for c in fields]
    rows = flat.where(strip(F.coalesce(F.col("audio_id"), F.lit(""))) != "")
    grouped = rows.groupBy("audio_id").agg(
        F.min_by("path", order).alias("path"), F.count("*").alias("num_segments"),
        F.sort_array(F.collect_list(F.struct(F.col(order).alias("__order"), *filled))).alias("s"),
    )
    return grouped.select("audio_id", "path", "num_segments", F.transform("s", lambda x: F.struct(*(x[c].alias(c) for c in fields))).alias("segments"))


def split_long(flat: DataFrame, min_dur: float = 1.0, max_dur: float = 30.0) -> DataFrame:
    """Segments cut into pieces of at most ``max_dur`` seconds (0: no limit), pieces below ``min_dur`` dropped, times to three digits."""
    dur = F.col("end_sec") - F.col("start_sec")
    if max_dur <= 0:
        pieces = F.lit(0)
    else:
        pieces = F.when(dur > max_dur, F.ceil(dur / max_dur).cast("int") - 1).otherwise(F.lit(0))
    rows = flat.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(pieces, F.lit(0)))))
    if max_dur > 0:
        start = F.col("start_sec") + F.col("piece") * max_dur
        rows = rows.withColumns({"start_sec": start, "end_sec": F.when(F.col("piece") < pieces, start + max_dur).otherwise(F.col("end_sec"))})
    rows = rows.where(F.col("end_sec") - F.col("start_sec") >= min_dur)
    return rows.withColumns({"duration_sec": F.round(F.col("end_sec") - F.col("start_sec"), 3), "start_sec": F.round("start_sec", 3), "end_sec": F.round("end_sec", 3)})


def duration_gate(flat: DataFrame, min_dur: float = 1.0, max_dur: float = 30.0, guard: bool = True) -> DataFrame:
    """Segments of ``min_dur`` to ``max_dur`` seconds; with ``guard`` a limit of 0 is none."""
    dur = F.col("end_sec") - F.col("start_sec")
    keep = dur >= min_dur
    return flat.where(keep if guard and max_dur <= 0 else keep & (dur <= max_dur))


def readable(flat: DataFrame, rate: int = 16_000) -> DataFrame:
    """Segments that hold at least one frame."""
    return flat.where(samples(F.col("end_sec"), rate) > samples(F.col("start_sec"), rate))


def scorable(flat: DataFrame, min_dur: float = 1.0, rate: int = 16_000) -> DataFrame:
    """Segments long enough, in frames, for quality scores."""
    return flat.where(samples(F.col("end_sec"), rate) - samples(F.col("start_sec"), rate) >= int(min_dur * rate))


def gap_merge(frames: DataFrame, key: str, order: list[str], time_us: str, gap_us: int) -> DataFrame:
    """(key, island, first_us, last_us, n): runs of active frames parted by more than ``gap_us``."""
    w = Window.partitionBy(key).orderBy(*order)
    new = F.coalesce((F.col(time_us) - F.lag(time_us).over(w) > gap_us).cast("int"), F.lit(0))
    rows = frames.withColumn("__new", new).withColumn("island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(key, "island").agg(F.min(time_us).alias("first_us"), F.max(time_us).alias("last_us"), F.count("*").alias("n"))

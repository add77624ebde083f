"""Windowed quality scores: window plans, calibration, gates and the exact quantile filter."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_SEC = 9
RATE = 16_000


@dataclass(frozen=True)
class QualityFloors:
    min_dur: float = 2.0
    max_dur: float = 20.0
    min_ovr: float | None = 3.0
    min_sig: float | None = None
    min_bak: float | None = None
    keep_quantile: float | None = None


def padded_samples(n: Column, padding: str, window_sec: int = WINDOW_SEC, rate: int = RATE) -> Column:
    """Samples after a short segment is repeated to the window's length: by ``double`` again and again, or as a ``tile``."""
    need = window_sec * rate
    if padding == "double":
        copies = F.get(F.filter(F.transform(F.sequence(F.lit(0), F.lit(20)), lambda k: F.expr("1L") * F.pow(F.lit(2), k).cast("bigint")), lambda c: n * c >= need), F.lit(0))
    elif padding == "tile":
        copies = F.ceil(F.lit(need) / n).cast("bigint")
    else:
        raise ValueError(f"unknown padding {padding}")
    return F.when(n >= need, n).when(n > 0, n * copies)


def hops(n: Column, window_sec: int = WINDOW_SEC, rate: int = RATE) -> Column:
    """Windows of one second's hop over so many samples, at least one."""
    return F.greatest(F.floor(n / rate) - window_sec + 1, F.lit(1)).cast("bigint")


def window_plan(segments: DataFrame, padding: str = "double", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each window of each segment: (seg_id, hop, first_sample, end_sample) in the padded samples, and the columns ``keep``."""
    n = padded_samples((F.col("duration_sec") * RATE).cast("bigint"), padding)
    rows = segments.withColumn("__n", n).where("__n > 0")
    rows = rows.select("seg_id", *keep, F.explode(F.sequence(F.lit(0).cast("bigint"), hops(F.col("__n")) - 1)).alias("hop"))
    return rows.select("seg_id", *keep, "hop", (F.col("hop") * RATE).alias("first_sample"), ((F.col("hop") + WINDOW_SEC) * RATE).alias("end_sample"))


def window_mean(scores: DataFrame, key: str, cols: list[str]) -> DataFrame:
    return scores.groupBy(key).agg(*(F.avg(c).alias(c) for c in cols))


def _number(c: str) -> Column:
    """NaN is as good as missing."""
    return F.when(~F.isnan(c), F.col(c))


def basic_filter(segments: DataFrame, floors: QualityFloors) -> DataFrame:
    """Rows with a path, readable times within the limits and scores at or above the floors of signal and background; missing ones fail."""
    keep = (F.coalesce(F.trim("path"), F.lit("")) != "") & (_number("end_sec") > _number("start_sec")) & _number("mos_ovr").isNotNull()
    keep &= _number("duration_sec").between(floors.min_dur, floors.max_dur)
    for c, least in (("mos_sig", floors.min_sig), ("mos_bak", floors.min_bak)):
        if least is not None:
            keep &= _number(c) >= least
    return segments.where(keep)


def quality_filter(segments: DataFrame, floors: QualityFloors) -> DataFrame:
    """``basic_filter``, then a floor of the overall score: the exact quantile that keeps ``keep_quantile`` of the rows if that is given, else ``min_ovr``.

    The threshold is one row, sent to the filter by a broadcast cross join.
    """
    rows = basic_filter(segments, floors)
    if floors.keep_quantile is None:
        return rows if floors.min_ovr is None else rows.where(F.col("mos_ovr") >= floors.min_ovr)
    limit = rows.agg(F.percentile("mos_ovr", F.lit(1 - floors.keep_quantile)).alias("__limit"))
    return rows.crossJoin(F.broadcast(limit)).where("mos_ovr >= __limit").drop("__limit")


def in_order(segments: DataFrame) -> DataFrame:
    return segments.orderBy("audio_id", "start_sec", "end_sec")


def inline_gate(segments: DataFrame, min_ovr: float = 2.0, min_sig: float = 2.0, min_bak: float = 3.5) -> DataFrame:
    """Scores are rounded to three digits, then rows with any below its floor are dropped; missing scores pass."""
    rows = segments.withColumns({c: F.round(c, 3) for c in ("mos_ovr", "mos_sig", "mos_bak")})
    drop = F.lit(False)
    for c, least in (("mos_ovr", min_ovr), ("mos_sig", min_sig), ("mos_bak", min_bak)):
        drop |= F.coalesce(F.col(c) < least, F.lit(False))
    return rows.where(~drop)

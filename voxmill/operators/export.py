"""Label records of finished segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import export_uid, segment_uuid
from ..functions.text import safe_name, strip

OPTIONAL = (*(f"mos_{k}" for k in ("ovr", "sig", "bak")), "error", "spk_id", *(f"sim_{k}" for k in ("file", "spk")))


def export_labels(items: DataFrame, row: str, require_text: bool = True, audio_dir: str = "audio", suffix: str = "wav") -> DataFrame:
    """Label records; the uid holds the item's number among all items, so rejected items leave gaps. Optional columns pass through where present.

    Rejected are items without text (if required), without a source or with an end not after the start.
    """
    text, src = strip(F.coalesce("text", F.lit(""))), F.coalesce("path", F.lit(""))
    keep = (src != "") & (F.col("end_sec") > F.col("start_sec"))
    if require_text:
        keep &= text != ""
    uid = export_uid(F.col(row), safe_name(F.coalesce("audio_id", F.lit("audio"))), safe_name(F.coalesce("seg_id", F.col(row).cast("string"))))
    rest = [F.col(c) for c in OPTIONAL if c in items.columns]
    return items.where(keep).select(
        uid.alias("uid"), "audio_id", "seg_id", F.concat(F.lit(f"{audio_dir}/"), uid, F.lit(f".{suffix}")).alias("path"), text.alias("text"), src.alias("source_path"),
        "start_sec", "end_sec", F.coalesce("duration_sec", F.col("end_sec") - F.col("start_sec")).alias("duration_sec"), "lang", "lang_prob", *rest,
    )


def clean_tokens(tokens: Column) -> Column:
    """Tokens trimmed, empty ones dropped, times to three digits."""
    plain = F.transform(tokens, lambda t: F.struct(strip(t["token"]).alias("token"), F.round(t["start"], 3).alias("start"), F.round(t["end"], 3).alias("end")))
    return F.filter(plain, lambda t: t["token"] != "")


def tar_records(segments: DataFrame, model: str, rate: int = 16_000) -> DataFrame:
    """Records of segments of tar members; ``wav_uuid`` is the segment's id, scores stay with them."""
    dur = F.round(F.col("seg_end") - F.col("seg_start"), 4)
    rest = [F.col(c) for c in ("lang_prob", "mos_ovr", "mos_sig", "mos_bak") if c in segments.columns]
    return segments.select(
        "tar_path", "wav", segment_uuid(F.col("wav_uuid"), F.col("seg_start")).alias("wav_uuid"), "wav_offset", "wav_size", "seg_start", "seg_end", dur.alias("duration"),
        (dur * rate).cast("bigint").alias("num_sample"), "text_lang", F.create_map(F.lit(model), F.col("text")).alias("transcribe"),
        F.create_map(F.lit(model), clean_tokens(F.col("tokens"))).alias("timestamp"), *rest,
    )

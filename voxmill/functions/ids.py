"""Identities of recordings, segments and speakers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


#: In order of preference: S-numbers, id-numbers, spoken-for names, pairs of numbers, then any number of 3 to 6 digits.
SPEAKER_PATTERNS = (
    r"\bS\d{3,6}\b",
    r"\bid\d{3,6}\b",
    r"\bspk(?:er|r)?[_-]?\d{1,6}\b",
    r"\bspeaker[_-]?\d{1,6}\b",
    r"\b\d{3,6}[_-]\d{3,6}\b",
    r"(?<!\d)\d{3,6}(?!\d)",
)
SPLITS = ("train", "dev", "test")
CORPUS_SPLITS = ("dev-clean", "dev-other", "test-clean", "test-other", "train-clean-100", "train-clean-360", "train-other-500")


def segment_id(audio_id: Column, ordinal: Column) -> Column:
    """The recording's id and the ordinal in at least three digits; null without a recording. Java's formatter serves only what padding can't."""
    digits = ordinal.cast("string")
    padded = F.when(ordinal.between(0, 999), F.lpad(digits, 3, "0")).when(ordinal >= 1000, digits).otherwise(F.format_string("%03d", ordinal))
    return F.concat(audio_id, F.lit("_seg"), padded)


def member_uuid(tar_path: Column, member: Column) -> Column:
    return F.sha2(F.concat(tar_path, F.lit("::"), member), 256)


def segment_uuid(wav_uuid: Column, start_sec: Column) -> Column:
    """The hash of a member's id and its start to four digits."""
    return F.sha2(F.concat(wav_uuid, F.lit("::"), F.format_string("%.4f", F.round(start_sec, 4))), 256)


def audio_id(path: Column, root: str, flat: bool = False) -> Column:
    """The path below ``root`` without its extension; ``flat`` joins its folders by ``_``."""
    rest = F.regexp_replace(F.regexp_replace(path, f"^(file:)?/*{root.strip('/')}/+", ""), r"\.[^./]*$", "")
    return F.regexp_replace(rest, "/", "_") if flat else rest


def export_uid(ordinal: Column, audio: Column, segment: Column, digits: int = 8) -> Column:
    return F.concat_ws("_", F.format_string(f"%0{digits}d", ordinal), audio, segment)


def _first_hit(text: Column, patterns: tuple[str, ...]) -> Column:
    """The match of the first pattern that matches at all."""
    return F.coalesce(*(F.nullif(F.regexp_extract(text, p, 0), F.lit("")) for p in patterns))


def parse_speaker(audio: Column, path: Column, extra: tuple[str, ...] = ()) -> Column:
    """The speaker named in the recording's id, else in its path from the right, else the folder below a split, else UNKNOWN."""
    patterns = (*extra, *SPEAKER_PATTERNS)
    audio = strip(F.coalesce(audio, F.lit("")))
    parts = F.filter(F.split(strip(F.coalesce(path, F.lit(""))), "/"), lambda x: (x != "") & (x != "."))
    hits = F.filter(F.transform(F.reverse(parts), lambda x: _first_hit(x, patterns)), lambda x: x.isNotNull())

    def below(names: tuple[str, ...]) -> Column:
        pairs = F.zip_with(parts, F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda a, b: F.when(a.isin(*names), b))
        return F.get(F.filter(pairs, lambda x: x.isNotNull()), F.lit(0))

    return F.coalesce(_first_hit(audio, patterns), F.get(hits, F.lit(0)), below(SPLITS), below(CORPUS_SPLITS), F.lit("UNKNOWN"))


def file_id(audio: Column, path: Column) -> Column:
    """The recording's id, else the file's name without extension, else UNKNOWN_FILE."""
    stem = F.regexp_replace(F.regexp_extract(F.coalesce(path, F.lit("")), r"([^/]+)/*$", 1), r"(?<=.)\.[^.]*$", "")
    return F.coalesce(F.nullif(strip(audio), F.lit("")), F.nullif(stem, F.lit("")), F.lit("UNKNOWN_FILE"))

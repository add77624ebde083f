"""Language decisions from one probe segment for each recording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def target_list(targets: list[str] | str) -> list[str]:
    """Lower-case codes of a list or of text with commas or spaces, each once, in order."""
    parts = targets.replace(",", " ").split() if isinstance(targets, str) else [y for x in targets for y in x.replace(",", " ").split()]
    return list(dict.fromkeys(p.lower() for p in parts))


def language_hit(lang: Column, targets: list[str]) -> Column:
    """Whether a language or its base (``zh`` of ``zh-cn``) is a target; no targets accept none."""
    low = F.lower(F.trim(F.coalesce(lang, F.lit(""))))
    return (low != "") & (low.isin(*targets) | F.get(F.split(low, "-"), F.lit(0)).isin(*targets)) if targets else F.lit(False)


def probe_longest(segments: DataFrame, audio: str, duration: str, order: str) -> DataFrame:
    """The longest segment of each recording, of equals the first; a missing duration is 0. ``order`` tells a recording's segments apart.

    Two hashed aggregates of narrow columns find the segment's place, by which its row is joined.
    """
    narrow = segments.select(audio, F.col(order).alias("__o"), F.coalesce(F.col(duration), F.lit(0)).alias("__d"))
    most = narrow.groupBy(audio).agg(F.max("__d").alias("__d"))
    place = narrow.join(most, [audio, "__d"]).groupBy(audio).agg(F.min("__o").alias(order))
    return segments.join(place, [audio, order], "left_semi")


def lid_decision(segments: DataFrame, targets: list[str], min_prob: float = 0.90, lang: str = "lang", prob: str = "lang_prob", status: str = "status") -> DataFrame:
    """Adds ``lang_keep_reason``: lid_error, too_short_for_lid, not_target_lang, low_lang_prob or keep, the first that holds."""
    reason = (
        F.when(F.col(status).startswith("lid_error"), "lid_error").when(F.col(status) == "too_short_for_lid", "too_short_for_lid")
        .when(~language_hit(F.col(lang), target_list(targets)), "not_target_lang")
        .when(F.coalesce(F.col(prob), F.lit(0.0)) < min_prob, "low_lang_prob").otherwise("keep")
    )
    return segments.withColumn("lang_keep_reason", reason)


def gate_by_first(segments: DataFrame, audio: str, order: str, targets: list[str], min_prob: float = 0.90, usable: Column | None = None) -> DataFrame:
    """Keeps the segments of recordings whose first usable segment is in a target language (none given: any) with enough probability.

    The probe's language and probability replace the segments' own. The probe's
    place is a hashed aggregate of one row a recording, joined back, so a recording with
    very many segments is no single window; ``order`` tells a recording's segments apart.
    """
    probes = segments if usable is None else segments.where(usable)
    place = probes.groupBy(audio).agg(F.min(order).alias(order))
    keep = F.col("lang_prob") >= min_prob
    if targets:
        keep &= F.col("lang").isin(*targets)
    probe = probes.join(place, [audio, order], "left_semi").where(keep).select(audio, "lang", "lang_prob")
    rows = segments.drop("lang", "lang_prob").join(probe, audio)
    return rows.select(*(c for c in segments.columns if c not in ("lang", "lang_prob")), "lang", "lang_prob")


def keep_ratio(decided: DataFrame, reason: str = "lang_keep_reason") -> DataFrame:
    return decided.agg(F.count("*").alias("n"), F.sum((F.col(reason) == "keep").cast("bigint")).alias("kept"), F.round(F.avg((F.col(reason) == "keep").cast("int")), 6).alias("ratio"))

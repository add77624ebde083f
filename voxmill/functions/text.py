"""Text functions as column expressions: transcript normalization, safe names, tags, tolerant numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The marks that transcripts lose.
PUNCTUATION = "!\"'(),.:;?[]—…、。《》【】！（），：；？"
#: White space of Unicode and the four ASCII separators, as the body of a character class that Java and RE2 read alike.
SPACES = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_NUMBER = r"^[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+)?$"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{SPACES}]+|[{SPACES}]+$", "")


def norm_text(text: Column) -> Column:
    """Trimmed, white space squeezed to one space, listed punctuation deleted, lower case; null is empty."""
    bare = F.translate(F.coalesce(text, F.lit("")), PUNCTUATION, "")
    return F.trim(F.regexp_replace(F.lower(bare), f"[{SPACES}]+", " "))


def safe_name(name: Column, squeeze: bool = True, default: str = "na") -> Column:
    """Characters other than letters, digits, ``._-`` become ``_``; with ``squeeze`` runs shrink to one, ends are trimmed and nothing becomes the default."""
    name = F.coalesce(name, F.lit(""))
    if not squeeze:
        return F.regexp_replace(name, r"[^A-Za-z0-9_.-]", "_")
    plain = F.regexp_replace(F.regexp_replace(name, r"[^A-Za-z0-9_.-]+", "_"), "_+", "_")
    plain = F.regexp_replace(plain, "^_+|_+$", "")
    return F.when(plain == "", F.lit(default)).otherwise(plain)


def sanitize_id(name: Column, most: int = 80) -> Column:
    plain = strip(F.coalesce(name, F.lit("")))
    return F.when(plain == "", F.lit("UNKNOWN")).otherwise(F.left(F.regexp_replace(plain, r"[^A-Za-z0-9_.-]+", "_"), F.lit(most)))


def strip_special_tokens(text: Column) -> Column:
    """The text without ``<|...|>`` marks, trimmed."""
    return strip(F.regexp_replace(text, r"<\|[^|]+\|>", ""))


def tag_name(tag: Column) -> Column:
    """A language mark such as ``<|en|>`` without its brackets."""
    return F.btrim(tag, F.lit("<>|"))


def parse_float(text: Column, default: float | None = None, keep_nan: bool = False) -> Column:
    """A double, or the default where the text is no number; "", "nan" and null are missing too, unless ``keep_nan`` lets NaN through."""
    plain = strip(text)
    low = F.lower(plain)
    sign = F.when(low.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    special = F.regexp_replace(low, r"^[+-]", "")
    value = F.when(plain.rlike(_NUMBER), F.regexp_replace(plain, "_", "").try_cast("double")).when(
        special.isin("inf", "infinity"), F.concat(sign, F.lit("Infinity")).try_cast("double")
    )
    if keep_nan:
        value = F.when(special == "nan", F.lit(float("nan"))).otherwise(value)
    return value if default is None else F.coalesce(value, F.lit(default))


def error_class(message: Column) -> Column:
    """``asr_failed:oom`` for messages about exhausted memory, else ``asr_failed:asr_error``; null stays null."""
    low = F.lower(message)
    return F.when(message.isNull(), F.lit(None).cast("string")).when(
        low.contains("out of memory") | (low.contains("cuda") & low.contains("memory")), F.lit("asr_failed:oom")
    ).otherwise(F.lit("asr_failed:asr_error"))


def error_isolated(error: Column) -> Column:
    """Whether a row carries no error."""
    return error.isNull() | (error == "")

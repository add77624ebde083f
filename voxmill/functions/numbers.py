"""Numeric functions as column expressions: rounding, calibration, sample counts, vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SAMPLE_RATE = 16_000
#: Of each kind of score the constant, linear and quadratic coefficient, by profile.
CALIBRATION = {
    "batch": {
        "ovr": (0.8924546794696789, 0.6609981731940616, 0.0760026953024318),
        "sig": (0.9651228012789437, 0.6592637550310214, 0.07572372955623895),
        "bak": (-3.7334600111017817, 2.700114234092929, -0.17213329073409228),
    },
    "pipeline": {
        "ovr": (0.8924547, 0.6609982, 0.0760027),
        "sig": (0.9651228, 0.6592638, 0.07572373),
        "bak": (-3.73346, 2.700114, -0.1721333),
    },
}


def calibrate(raw: Column, kind: str, profile: str = "batch") -> Column:
    a, b, c = CALIBRATION[profile][kind]
    return F.lit(a) + F.lit(b) * raw + F.lit(c) * raw * raw


def millis(seconds: Column) -> Column:
    """Whole milliseconds, by which times are joined."""
    return F.round(seconds * 1000).cast("bigint")


def samples(seconds: Column, rate: int = SAMPLE_RATE) -> Column:
    """Frames before a time, cut off as an integer conversion does."""
    return (seconds * rate).cast("bigint")


def decode_budget(longest_sec: Column) -> Column:
    """Tokens to decode for a batch whose longest segment has so many seconds: 25 a second and 50, between 50 and 448."""
    return F.greatest(F.lit(50), F.least(F.lit(448), (longest_sec * 25 + 50).cast("int")))


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def l2_normalize(v: Column) -> Column:
    v = v.cast("array<double>")
    return F.transform(v, lambda x: x / (norm(v) + F.lit(1e-12)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity between -1 and 1; null with a null vector."""
    a, b = a.cast("array<double>"), b.cast("array<double>")
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    value = dot / ((norm(a) + F.lit(1e-12)) * (norm(b) + F.lit(1e-12)))
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value)))

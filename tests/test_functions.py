"""Column functions against plain Python, with generated input."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxmill.functions import ids, numbers, text
from voxmill.operators.language import target_list
from voxmill.operators.speaker import greedy_labels

MARKS = set("!\"'(),.:;?[]—…、。《》【】！（），：；？")


def norm(x):
    return " ".join("".join(c.lower() for c in x or "" if c not in MARKS).split())


def test_norm_text(spark):
    r = random.Random(1)
    chars = list("aB é\t\n　  .,!?，。《》中文Ｚ\x1c'\"()-—…İ")
    some = ["".join(r.choice(chars) for _ in range(r.randrange(20))) for _ in range(300)] + [None, "", "  ", "，，"]
    some = [s.replace("İ", "I") if s else s for s in some]
    df = spark.createDataFrame([(s,) for s in some], "t string").select(text.norm_text(F.col("t")).alias("n"))
    assert [x.n for x in df.collect()] == [norm(s) for s in some]


def number(x):
    try:
        v = float(x)
        return None if v != v else v
    except (TypeError, ValueError):
        return None


def test_parse_float(spark):
    some = ["", "nan", "NaN", "abc", "3d", "1_0", " 5.5 ", "-2e3", "+.5", "1__0", "_1", "inf", "-Infinity", "0x10", None, "1e", "1.", "."]
    df = spark.createDataFrame([(s,) for s in some], "t string").select(text.parse_float(F.col("t")).alias("v"))
    assert [x.v for x in df.collect()] == [number(s) for s in some]


@pytest.mark.parametrize(
    "audio,path,want",
    [
        ("S0012-x", "", "S0012"), ("a 12", "/d/spk3/id0012/x.wav", "id0012"), ("clip", "/d/train/bob/x.wav", "bob"), ("clip", "/d/test-clean/ann/x.wav", "ann"), ("", "", "UNKNOWN"),
        (None, None, "UNKNOWN"), ("ab123cd", "", "123"), ("123_456", "", "123_456"), ("clip", "/train", "UNKNOWN"), ("id123456789", "", "UNKNOWN"),
    ],
)
def test_parse_speaker(spark, audio, path, want):
    df = spark.createDataFrame([(audio, path)], "a string, p string")
    assert df.select(ids.parse_speaker(F.col("a"), F.col("p")).alias("s")).first().s == want


def test_ids(spark):
    df = spark.range(1).select(
        ids.segment_id(F.lit("a"), F.lit(1234)).alias("long"), ids.segment_id(F.lit("a"), F.lit(7)).alias("short"), ids.audio_id(F.lit("file:/r/x/b.WAV"), "/r", True).alias("flat"),
        ids.audio_id(F.lit("file:/r/x/b.WAV"), "/r").alias("deep"), ids.file_id(F.lit(" "), F.lit("/q/z.tar.gz")).alias("file"), text.safe_name(F.lit("__é?")).alias("name"),
        text.sanitize_id(F.lit("x" * 99)).alias("id"), numbers.decode_budget(F.lit(100.0)).alias("budget"),
    ).first()
    assert tuple(df) == ("a_seg1234", "a_seg007", "x_b", "x/b", "z.tar", "na", "x" * 80, 448)


def test_speaker_patterns_are_those_of_the_corpora():
    assert ids.CORPUS_SPLITS == ("dev-clean", "dev-other", "test-clean", "test-other", "train-clean-100", "train-clean-360", "train-other-500")
    assert numbers.CALIBRATION["pipeline"]["ovr"] == pytest.approx(numbers.CALIBRATION["batch"]["ovr"], abs=1e-6) and set(text.PUNCTUATION) == MARKS


def test_targets():
    assert target_list(["en,zh", "EN", "fr"]) == ["en", "zh", "fr"] and target_list("zh en,zh") == ["zh", "en"]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=30))
def test_greedy_clusters_of_axes(axes):
    import numpy as np

    labels = greedy_labels(np.eye(6)[axes], 0.74)
    seen = {}
    assert labels == [seen.setdefault(a, len(seen)) for a in axes]

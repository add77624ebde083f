"""Operators on rows chosen for their edges."""

import random

import pytest
from pyspark.sql import functions as F

from voxmill.functions.ids import segment_id
from voxmill.materialize import ROWS_A_TASK, spread, with_row_number
from voxmill.operators import export, language, merge, quality, segments, speaker, training

SEGMENT = "seg_id string, audio_id string, path string, seg_idx bigint, start_sec double, end_sec double, duration_sec double, mos_ovr double, mos_sig double, mos_bak double"


def split_by_hand(start, end, low, high):
    if high <= 0 or end - start <= high:
        return [(start, end)] if end - start >= low else []
    out, at = [], start
    while at < end:
        nxt = min(at + high, end)
        if nxt - at >= low:
            out.append((at, nxt))
        at = nxt
    return out


@pytest.mark.parametrize("high", [0, 5, 30])
def test_split_long(spark, high):
    r = random.Random(high)
    spans = [(0.0, 0.0), (3.0, 1.0), (0.0, 30.0), (1.0, 31.0), (0.0, 65.0)] + [(float(r.randrange(9)), float(r.randrange(90)) / 4) for _ in range(40)]
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(spans)], "k int, start_sec double, end_sec double")
    found = sorted((x.k, x.start_sec, x.end_sec) for x in segments.split_long(df, 1.0, high).collect())
    assert found == sorted((k, a, b) for k, s in enumerate(spans) for a, b in split_by_hand(*s, 1.0, high))


def test_nest_and_explode(spark):
    rows = [("x1", "b", "/p2", 1, 2.0, 3.0, 1.0), ("x0", "b", "/p1", 0, 0.0, 1.0, None), ("y", " ", "/q", 0, 0.0, 1.0, 1.0), ("z", None, "/q", 0, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "seg_id string, audio_id string, path string, seg_idx bigint, start_sec double, end_sec double, duration_sec double")
    nested = segments.nest_segments(df)
    r = nested.first()
    assert nested.count() == 1 and r.path == "/p1" and [s.seg_id for s in r.segments] == ["x0", "x1"] and r.segments[0].duration_sec == 0.0
    flat = segments.explode_segments(segments.nest_segments(df, fields=("start_sec", "end_sec"))).orderBy("seg_idx").collect()
    assert [x.seg_id for x in flat] == ["b_seg000", "b_seg001"]


def rows_of(spark, *values):
    return spark.createDataFrame([(f"s{k}", "a", "/p", k, 0.0, d, d, o, s, b) for k, (d, o, s, b) in enumerate(values)], SEGMENT)


def test_quality_gates(spark):
    nan = float("nan")
    df = rows_of(spark, (5.0, 3.0, 3.0, 4.0), (5.0, None, 3.0, 4.0), (5.0, nan, 3.0, 4.0), (0.5, 3.0, 3.0, 4.0), (5.0, 2.0, None, 4.0), (5.0, 2.9996, 3.0, 3.4996))
    ids = lambda x: sorted(r.seg_id for r in x.collect())
    assert ids(quality.quality_filter(df, quality.QualityFloors(2, 20, 3.0))) == ["s0"]
    assert ids(quality.quality_filter(df, quality.QualityFloors(2, 20, 1.0, min_sig=2.0))) == ["s0", "s5"]
    assert ids(quality.quality_filter(df, quality.QualityFloors(2, 20, keep_quantile=0.5))) == ["s0", "s5"]
    assert ids(quality.quality_filter(df.limit(0), quality.QualityFloors(keep_quantile=0.5))) == []
    assert ids(quality.inline_gate(df, 3.0, 2.0, 3.5)) == ["s0", "s1", "s2", "s3", "s5"]


def test_window_plan(spark):
    df = rows_of(spark, (4.0, 1.0, 1.0, 1.0), (9.0, 1.0, 1.0, 1.0), (9.5, 1.0, 1.0, 1.0), (30.0, 1.0, 1.0, 1.0), (0.0, 1.0, 1.0, 1.0))
    count = lambda p: {r.seg_id: r["count"] for r in quality.window_plan(df, p).groupBy("seg_id").count().collect()}
    assert count("double") == {"s0": 8, "s1": 1, "s2": 1, "s3": 22} and count("tile") == {"s0": 4, "s1": 1, "s2": 1, "s3": 22}


def test_language(spark):
    df = spark.createDataFrame([(1, "zh-CN", 0.9, "ok"), (2, "en", 0.89, "ok"), (3, "fr", 1.0, "ok"), (4, None, None, "lid_error:x"), (5, "zh", 1.0, "too_short_for_lid")], "k int, lang string, lang_prob double, status string")
    found = {r.k: r.lang_keep_reason for r in language.lid_decision(df, ["zh,en"]).collect()}
    assert found == {1: "keep", 2: "low_lang_prob", 3: "not_target_lang", 4: "lid_error", 5: "too_short_for_lid"}
    many = spark.createDataFrame([("a", 1, "zh", 0.95), ("a", 2, "en", 0.1), ("b", 1, "en", 0.99), ("b", 0, "zh", 0.5)], "audio string, ord int, lang string, lang_prob double")
    assert sorted(tuple(r) for r in language.gate_by_first(many, "audio", "ord", []).collect()) == [("a", 1, "zh", 0.95), ("a", 2, "zh", 0.95)]
    assert [tuple(r) for r in language.probe_longest(spark.createDataFrame([("a", 2, 5.0), ("a", 1, 5.0), ("a", 3, None)], "audio string, ord int, d double"), "audio", "d", "ord").collect()] == [("a", 1, 5.0)]


def test_speakers(spark):
    v = [(1, "s", "f", [1.0, 0.0]), (2, "s", "f", [0.8, 0.6]), (3, "t", "f", [0.0, 2.0]), (4, "u", "g", None)]
    df = spark.createDataFrame(v, "k int, spk string, file string, embedding array<float>")
    out = speaker.similarities(df, speaker.centroids(df, "spk"), speaker.centroids(df, "file"), "spk", "file")
    found = {r.k: r for r in speaker.decisions(out.withColumn("d", F.when(F.col("k") == 1, 0.1).otherwise(5.0)), F.col("d"), F.col("embedding"), min_file=0.75).collect()}
    assert {k: r.keep_reason for k, r in found.items()} == {1: "drop_short", 2: "keep", 3: "drop_file", 4: "drop_no_emb"}
    assert found[3].sim_spk == pytest.approx(1) and found[4].sim_spk == -1


def test_merges(spark):
    want = spark.createDataFrame([("a_seg000", "a", 0, 0.0, 1.0004), ("a_seg001", "a", 1, 1.0, 2.0)], "seg_id string, audio_id string, seg_idx int, start_sec double, end_sec double")
    got = spark.createDataFrame([("a_seg000", "a", 0.0, 1.0, "old", None, 0), ("a_seg000", "a", 0.0002, 1.0001, "new", None, 1)], "seg_id string, audio_id string, start_sec double, end_sec double, text string, error string, file int")
    found = {r.seg_id: (r.text, r.error) for r in merge.merge_transcripts(want, got, ["file"]).collect()}
    assert found == {"a_seg000": ("new", None), "a_seg001": ("", "missing_from_shards")}
    cache = spark.createDataFrame([(1, 10), (9, 90)], "k int, v int")
    out, made = merge.look_aside(spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int"), cache, "k", lambda m: m.distinct().withColumn("v", F.lit(0)))
    assert sorted(tuple(r) for r in out.collect()) == [(1, 10, "cached"), (2, 0, "computed")] and made.count() == 1
    assert {r.k: r.v for r in merge.resume_union(cache, spark.createDataFrame([(1, 11), (3, 30)], "k int, v int"), "k").collect()} == {1: 10, 3: 30, 9: 90}


def test_merge_counts_and_unique_order(spark):
    want = spark.createDataFrame([("s0",), ("s1",), ("s2",)], "seg_id string")
    got = spark.createDataFrame([("s0", 1.0, 0, 5), ("s0", 2.0, 1, 0), ("s1", 3.0, 0, 9), ("x", 4.0, 0, 1)], "seg_id string, v double, file int, line bigint")
    assert tuple(merge.merge_counts(want, got).first()) == (3, 2, 1, 1) and tuple(merge.merge_counts(want, got.limit(0)).first()) == (3, 0, 3, 0)
    for unique in (True, False):
        assert {r.seg_id: r.v for r in merge.last_of(got, ["seg_id"], ["file", "line"], unique).collect()} == {"s0": 2.0, "s1": 3.0, "x": 4.0}


def test_scores_of_edges(spark):
    """Repeated and null segments, a last score that is null, orders beyond 19 digits together, sorted by recording and ordinal."""
    want = spark.createDataFrame([("s2", "b", 0), ("s0", "a", 1), ("s0", "a", 1), ("s1", "a", 0), (None, "a", 2), ("s3", "a", 3), ("s4", None, 0)], "seg_id string, audio_id string, seg_idx int")
    got = spark.createDataFrame([("s0", "a", 1.0, "x", 9, 2**62), ("s0", "a", 2.0, "y", 10, 0), ("s1", "a", 3.0, "z", 2**62, 1), ("s1", "a", None, "n", 2**62, 2), (None, "a", 5.0, "o", 0, 0), ("s2", "b", 6.0, None, 0, 0), ("s4", None, 7.0, "p", 0, 0)], "seg_id string, audio_id string, v double, t string, file bigint, line bigint")
    rows = [("s1", "a", 0, None, "n"), ("s0", "a", 1, 2.0, "y"), ("s0", "a", 1, 2.0, "y"), ("s2", "b", 0, 6.0, None)]
    pick = lambda df: [tuple(r) for r in df.select("seg_id", "audio_id", "seg_idx", "v", "t").collect()]
    assert pick(merge.merge_scores(want, got.drop("audio_id"), ["file", "line"])) == [("s4", None, 0, 7.0, "p"), *rows]
    assert pick(merge.merge_scores(want, got, ["file", "line"], keys=("audio_id", "seg_id"))) == rows
    assert pick(merge.merge_scores(want, got.limit(0), ["file", "line"], keys=("audio_id", "seg_id"))) == []


def test_counts_of_edges(spark):
    """Repeated and null segments on either side, and keys that hold the recording too."""
    want = spark.createDataFrame([("s0", "a"), ("s0", "a"), ("s1", "a"), (None, "a")], "seg_id string, audio_id string")
    got = spark.createDataFrame([("s0", "a"), ("s0", "a"), ("s0", "a"), (None, "a"), (None, "a"), ("x", "b")], "seg_id string, audio_id string")
    for keys in (("seg_id",), ("audio_id", "seg_id")):
        assert tuple(merge.merge_counts(want, got, keys).first()) == (4, 2, 2, 3)
        assert tuple(merge.merge_counts(want.limit(0), got, keys).first()) == (0, 0, 0, 3) and tuple(merge.merge_counts(want, got.limit(0), keys).first()) == (4, 0, 4, 0)


def test_transcripts_of_edges(spark):
    """Repeated and null expected segments, a last result of nulls, results without a segment; further columns stay."""
    want = spark.createDataFrame([("a0", "a", 0.0, 1.0, 7), ("a0", "a", 0.0, 1.0, 8), (" a1", "a", 1.0, 2.0, 9), ("n", None, 0.0, 1.0, 10), ("a2", "a", None, 2.0, 11)], "seg_id string, audio_id string, start_sec double, end_sec double, k int")
    got = spark.createDataFrame([("a0", "a", 0.0, 1.0, "late", "slow", 1, 0), ("a0", "a", 0.0, 1.0, "early", None, 0, 9), ("a1 ", "a", 1.0, 2.0, None, None, 0, 1), ("a1", "a", 1.0, 2.0, "first", None, 0, 0), ("n", None, 0.0, 1.0, "x", None, 0, 0), ("a2", "a", None, 2.0, "x", None, 0, 0), ("z", "z", 0.0, 1.0, "x", None, 0, 0)], "seg_id string, audio_id string, start_sec double, end_sec double, text string, error string, file int, line int")
    found = {r.k: (r.seg_id, r.text, r.error) for r in merge.merge_transcripts(want, got, ["file", "line"]).collect()}
    assert found == {7: ("a0", "late", "slow"), 8: ("a0", "late", "slow"), 9: (" a1", "", None), 10: ("n", "", "missing_from_shards"), 11: ("a2", "", "missing_from_shards")}


def test_segment_ids(spark):
    df = spark.createDataFrame([("a", 0), ("a", 999), ("a", 1000), ("a", 123456), ("a", -1), (None, 3)], "a string, k bigint")
    assert [r.s for r in df.select(segment_id(F.col("a"), F.col("k")).alias("s")).collect()] == ["a_seg000", "a_seg999", "a_seg1000", "a_seg123456", "a_seg-01", None]


def test_spread_bounds_a_task(spark):
    parts = lambda rows: spread(spark.range(50), rows, "id").rdd.getNumPartitions()
    assert parts(9 * ROWS_A_TASK + 1) == 10 and parts(50) == spark.sparkContext.defaultParallelism and parts(0) == parts(50)


def test_cache_table(spark, tmp_path):
    cache = merge.CacheTable(spark, f"file://{tmp_path}/cache", "k", "k int, v string")
    assert cache.read().count() == 0
    cache.upsert(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    cache.upsert(spark.createDataFrame([(2, "c"), (3, None)], "k int, v string"))
    (tmp_path / "cache" / "batch=2").mkdir()  # a batch that was broken off has no success mark
    assert {r.k: r.v for r in cache.read().collect()} == {1: "a", 2: "c", 3: None}
    cache.compact()
    assert {r.k: r.v for r in cache.read().collect()} == {1: "a", 2: "c", 3: None}


def test_row_numbers_and_shards(spark):
    df = spark.range(101).withColumn("h", F.xxhash64("id")).repartition(5)
    rows = with_row_number(df, [F.col("h")]).orderBy("h").collect()
    assert [r.row for r in rows] == list(range(101)) and with_row_number(df.limit(0), [F.col("h")]).count() == 0
    shards = lambda n, k: [r.s for r in spark.range(n).select(merge.contiguous_shard(F.col("id"), n, k).alias("s")).collect()]
    assert shards(7, 3) == [0, 0, 1, 1, 2, 2, 2] and shards(2, 3) == [2, 2]


def test_training(spark):
    split = training.seeded_split(spark.range(1000), "id")
    assert {r.split: r["count"] for r in split.groupBy("split").count().collect()} == {"train": 960, "dev": 20, "test": 20}
    assert {r.split: r.n for r in training.split_hours(training.seeded_split(spark.range(1), "id").withColumn("duration_sec", F.lit(1.0))).collect()} == {"test": 1}
    vocab = training.char_vocab(spark.createDataFrame([(1, "ba a"), (2, "cb")], "k int, t string"), "t", "k")
    assert {r.token: r.id for r in vocab.collect()} == {"<pad>": 0, "<unk>": 1, "|": 2, "b": 3, "a": 4, "c": 5}


def test_split_edges_and_parity(spark):
    import hashlib
    import random as r

    rows = spark.range(977)
    order = sorted(range(977), key=lambda k: hashlib.sha256(f"20260605:{k}".encode()).hexdigest())
    want = {k: "test" if n < 19 else "dev" if n < 38 else "train" for n, k in enumerate(order)}
    assert {x.id: x.split for x in training.seeded_split(rows, "id").collect()} == want
    assert training.seeded_split(rows.limit(0), "id").columns == ["id", "split"]
    places = list(range(200))
    r.Random(5).shuffle(places)
    found = {x.id: x.split for x in training.shuffled_split(spark.range(200).repartition(3), [F.col("id")], seed=5).collect()}
    assert {k for k, s in found.items() if s == "test"} == set(places[:4]) and {k for k, s in found.items() if s == "dev"} == set(places[4:8])
    with pytest.raises(ValueError):
        training.shuffled_split(spark.range(20), [F.col("id")], most=10)


def test_label_items(spark):
    labels = spark.createDataFrame([({"b": "said", "a": ""}, "own", 0.0, 3.0, None, "u"), (None, "own", 2.0, 3.0, "en", None)], "transcribe map<string,string>, text string, duration double, duration_sec double, text_lang string, wav_uuid string")
    found = [(x.text, x.duration_sec, x.lang, x.key, x.mos_ovr) for x in training.label_items(labels).collect()]
    assert found == [("said", 3.0, "", "u", None), ("own", 2.0, "en", None, None)]
    assert training.label_items(labels, model="a").first().text == "own"


def test_known_speakers_stay(spark):
    v = [("f/1", 1, "S1", [1.0, 0.0]), ("f/1", 2, "UNKNOWN", [1.0, 0.0]), ("f/1", 3, "UNKNOWN", [0.8, 0.6]), ("f/1", 4, "UNKNOWN", [0.0, 1.0]), ("f/1", 5, "UNKNOWN", None), ("g", 6, None, [1.0, 0.0])]
    df = spark.createDataFrame(v, "file string, k int, spk string, embedding array<double>")
    found = {r.k: r.spk_final for r in speaker.greedy_clusters(df, "file", "k", "spk").collect()}
    assert found == {1: "S1", 2: "AUTO_f_1_p000", 3: "AUTO_f_1_p000", 4: "AUTO_f_1_p001", 5: "UNKNOWN", 6: None}


def test_records(spark):
    tokens = F.array(F.struct(F.lit(" a ").alias("token"), F.lit(0.12345).alias("start"), F.lit(1.0).alias("end")), F.struct(F.lit(" ").alias("token"), F.lit(0.0).alias("start"), F.lit(1.0).alias("end")))
    assert [tuple(t) for t in spark.range(1).select(export.clean_tokens(tokens).alias("t")).first().t] == [("a", 0.123, 1.0)]
    items = spark.createDataFrame([(0, "x/y", "s", "/p", " hi ", 0.0, 1.0), (1, "x", "s", "/p", " ", 0.0, 1.0), (2, "x", None, "/p", "t", 0.0, 1.0), (3, "x", "s", None, "t", 0.0, 1.0), (4, "x", "s", "/p", "t", 1.0, 1.0)], "row bigint, audio_id string, seg_id string, path string, text string, start_sec double, end_sec double")
    found = export.export_labels(items.withColumns({"duration_sec": F.lit(None).cast("double"), "lang": F.lit("en"), "lang_prob": F.lit(1.0)}), "row").collect()
    assert [(r.uid, r.text, r.duration_sec) for r in found] == [("00000000_x_y_s", "hi", 1.0), ("00000002_x_2", "t", 1.0)]


def test_islands(spark):
    df = spark.createDataFrame([("u", k, t) for k, t in enumerate([0, 5, 10, 30, 31, 60])], "u string, k int, t bigint")
    assert [(r.first_us, r.last_us, r.n) for r in segments.gap_merge(df, "u", ["t", "k"], "t", 10).orderBy("island").collect()] == [(0, 10, 3), (30, 31, 2), (60, 60, 1)]

"""Every operator on awkward tables: nulls, empty and very long texts, repeated rows, ties, clashing column names, no rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxmill.llm import decontam, lm_score, media, near_dup, passages, quality, sampling, secrets, token_counts, warc

LONG = " ".join(f"wort{k % 997}x{k % 31} été{k % 13}" for k in range(15_000))
ROWS = [
    (1, LONG, "en", "s", 5), (2, LONG, None, None, None), (3, None, "en", "s", 1), (4, "", "en", "s", 0), (5, "  \n\t ", "en", "s", 5), (6, "a", "en", "s", 1),
    (None, "orphan text of no id", "en", "s", 1), (None, None, None, None, None), (7, "same row", "en", "s", 1), (7, "same row", "en", "s", 1), (8, "日本語 ￿ \U0001f600 \x00 end", "en", "s", 1),
    (9, "x" * 100_000, "en", "s", 1),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ["score", "kept", "gone_id", "again_id", "band", "token", "node", "a", "b", "id", "__id", "good", "text_a", "run", "count", "threshold", "tokens"]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit(f"{c}!") for c in CLASH}).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0, "x"), (4, 0, 0, "x"), (None, 1, 0, "x"), (6, None, 0, "x"), (7, 0, 1, "x"), (7, 0, 1, "x")], "doc_id bigint, quality int, toxic int, score string")


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, "same row"), (1, "same row"), (2, None), (3, ""), (4, LONG[:400]), (None, "orphan text of no id"), (5, "a")]
    return spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))


def ids(df, col="doc_id"):
    return sorted((r[col] for r in df.select(col).collect()), key=lambda x: (x is None, x))


def test_quality(odd, none, labels):
    found = {r.doc_id: r for r in quality.judged(odd, labels).collect()}
    assert quality.judged(odd, labels).count() == len(ROWS) and found[3].score == found[4].score == found[5].score
    assert quality.judged(none, labels).count() == 0 and quality.keep_good(none, labels).columns == none.columns
    assert quality.judged(odd, labels.limit(0)).where("NOT kept").count() == 0
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns and set(ids(kept)) <= set(ids(odd))


def test_near_duplicates(odd, none):
    assert [(r.doc_id, r.kept_doc_id) for r in near_dup.near_duplicates(odd).collect()] == [(2, 1)]
    left = near_dup.drop_near_duplicates(odd)
    assert left.columns == odd.columns and ids(left) == [1, 3, 4, 5, 6, 7, 8, 9, None, None]
    assert near_dup.near_duplicates(none).count() == 0 and near_dup.drop_near_duplicates(none).count() == 0


def test_decontamination(odd, none, benchmark):
    found = {(r.doc_id, r.item_id) for r in decontam.find_leaks(odd, benchmark).collect()}
    assert found == {(1, 4), (2, 4), (7, 1), (6, 5)}
    assert ids(decontam.drop_leaks(odd, benchmark)) == [3, 4, 5, 8, 9, None, None]
    assert decontam.find_leaks(none, benchmark).count() == 0 and decontam.find_leaks(odd, benchmark.limit(0)).count() == 0
    assert decontam.drop_leaks(odd, benchmark.limit(0)).count() == len(ROWS)


def test_secrets(spark, odd, none):
    assert secrets.find_secrets(odd).count() == 0 and secrets.find_secrets(none).count() == 0
    key = "a3" * 20
    docs = spark.createDataFrame([(1, f"é token = \"{key}\" end"), (None, key), (2, None), (3, ""), (4, f"{key} {key}")], "doc_id bigint, text string")
    found = secrets.find_secrets(docs).collect()
    assert sorted((r.doc_id or 0, r.start, r.length, r.format) for r in found) == [(0, 0, 40, "hex_token_40"), (1, 11, 40, "hex_token_40"), (4, 0, 40, "hex_token_40"), (4, 41, 40, "hex_token_40")]
    masked = {r.doc_id: r.text for r in secrets.mask_secrets(docs).collect()}
    assert masked[1] == 'é token = "[hex_token_40]" end' and masked[4] == "[hex_token_40] [hex_token_40]" and masked[2] is None and masked[3] == ""
    table = spark.createDataFrame([("z", "pin-" + "1234567890"[k:] + "1234567890"[:k]) for k in range(10)] + [(None, "x" * 20), ("z", None), ("z", ""), ("z", "pin-1234567890")], "format string, credential string").withColumn("doc_id", F.lit(1))
    own = spark.createDataFrame([(1, "is pin-4567890123!"), (2, key)], "doc_id bigint, text string")
    assert [(r.doc_id, r.start, r.length, r.format) for r in secrets.find_secrets(own, labelled=table).collect()] == [(1, 3, 14, "z")]
    assert secrets.find_secrets(own, labelled=table.limit(0)).count() == 0 and secrets.mask_secrets(own, labelled=[]).count() == 2
    twins = [(name, "0" * 20) for name in ("b", "a")]  # equal margins: the first name
    assert [r.format for r in secrets.find_secrets(spark.createDataFrame([(1, "0" * 20)], "doc_id bigint, text string"), labelled=twins).collect()] == ["a"]
    same = secrets.mask_secrets(odd)
    assert same.columns == odd.columns and same.count() == len(ROWS)
    longer = secrets.mask_secrets(docs.withColumn("n_chars", F.length("text"))).where("doc_id = 4").first()
    assert longer.n_chars == len(longer.text)


def test_token_counts(odd, none):
    found = {r.doc_id: r.tokens for r in token_counts.count_tokens(odd).collect()}
    assert token_counts.count_tokens(odd).count() == len(ROWS) and found[3] == found[4] == 0 and found[5] > 0 and found[1] == found[2] > 15_000
    assert token_counts.count_tokens(none).count() == 0


def test_sampling(odd, none):
    rows = sampling.sample_segmentations(odd).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert all(r.decoded for r in rows)
    assert len(by[1]) == 2 and by[1][0].ids != by[1][1].ids
    assert [r.ids for r in by[4]] == [[]] and by[4][0].log_inclusion == 0 and [r.ids for r in by[3]] == [[]]
    assert len(by[7]) == 4 and len({tuple(r.ids) for r in by[7]}) == 2
    assert sampling.sample_segmentations(none).count() == 0


def test_passages(odd, none):
    found = {(r.doc_id, r.other_doc_id) for r in passages.repeated_passages(odd).collect()}
    assert found == {(1, 2), (2, 1)}
    assert passages.repeated_passages(none).count() == 0


def test_lm(odd, none):
    found = {r.doc_id: r for r in lm_score.pseudo_likelihoods(odd, vocabulary=500, rounds=1).collect()}
    assert None not in found and found[3].words == 0 and found[3].log_likelihood == 0 and found[1].log_likelihood == found[2].log_likelihood < 0
    assert lm_score.pseudo_likelihoods(none).count() == 0


def test_media(spark, odd, none):
    tiles = media.media_tiles(media.rendered(odd)).collect()
    assert len(tiles) == 4 * len(ROWS) and all(r.error is None for r in tiles)
    assert media.media_tiles(media.rendered(none)).count() == 0
    grey = media.encode_netpbm(np.zeros((1, 1), np.uint8))
    bad = [(1, None), (2, b""), (3, b"P5 0 0 255 "), (4, b"BM"), (5, b"P6\n9 9\n255\nxx"), (None, grey), (7, b"P9 junk"), (8, b"BM" + b"\xff" * 80)]
    rows = media.media_tiles(spark.createDataFrame(bad, "media_id bigint, content binary").withColumn("npy", F.lit(1))).collect()
    assert sum(r.error is not None for r in rows) == 7 and sum(r.media_id is None and r.dhash == 0 for r in rows) == 4


def test_stages(spark, odd, none, tmp_path):
    """Each stage and the whole pipeline on nulls, repeats, clashing columns and no rows."""
    import corpus_pipeline

    tables = {
        "labels": spark.createDataFrame([(1, 1, 0), (2, 1, 0), (6, 0, 0), (9, 0, 1), (None, 1, 0)], "doc_id bigint, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, "same row"), (2, None)], "item_id bigint, text string"), "documents": odd,
    }
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and out.count() <= docs.count(), name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).where("NOT decoded").count() == 0
    assert 7 not in ids(corpus_pipeline.decontamination_stage(spark, odd, str(tmp_path))) and corpus_pipeline.secrets_stage(spark, odd, str(tmp_path)).count() == len(ROWS)
    assert corpus_pipeline.run(spark, str(tmp_path)).columns[0] == "doc_id"


def test_ties(spark):
    """Equally similar windows: the first; words of equal count: one decision for both; equal scores: one decision."""
    twice = spark.createDataFrame([(1, "x y z one two three x y z one two three")], "doc_id bigint, text string")
    assert [r.first_word for r in decontam.find_leaks(twice, spark.createDataFrame([(5, "one two three")], "item_id bigint, text string")).collect()] == [3]
    even = spark.createDataFrame([(1, "a b"), (2, "b a"), (3, "a b")], "doc_id bigint, text string")
    found = {r.doc_id: r.log_likelihood for r in lm_score.pseudo_likelihoods(even, vocabulary=1, classes=4, own=1, members=4, rounds=1).collect()}
    assert found[1] == found[3] and len(found) == 3
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert len({r.kept for r in quality.judged(even.withColumn("text", F.lit("same")), labels).collect()}) == 1


def test_warc(spark):
    rows = [("http://b.com/x", 5, 1, "d"), ("http://b.com/x", 5, 1, "d"), ("HTTP://www.b.com:80/x#f", None, 2, None), (None, 1, 3, "d"), ("", 1, 4, "e"), ("b.com/x", 9, None, "e"), ("http://a.b.com?q", 1, 5, "z" * 50_000)]
    captures = spark.createDataFrame(rows, "url string, ts bigint, page_id bigint, digest string").withColumns({"run": F.lit(1), "url_key": F.lit("k")})
    read = lambda **k: [(r.url_key, r.ts, r.page_id, r.capture, r.since_previous, r.changed) for r in warc.capture_histories(captures.repartition(3), **k).collect()]
    found = read()
    assert read(rows_per_part=1) == found == [
        (")/", 1, 4, 1, None, True), ("com,b)/x", None, 2, 1, None, True), ("com,b)/x", 5, 1, 2, None, True), ("com,b)/x", 5, 1, 3, 0, False), ("com,b)/x", 9, None, 4, 4, True),
        ("com,b,a)/?q", 1, 5, 1, None, True),
    ]
    assert warc.capture_histories(captures.limit(0)).count() == 0

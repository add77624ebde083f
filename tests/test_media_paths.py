"""Audio, tar shards, sinks, scorers and the streaming path on generated files."""

import hashlib
import io
import json
import math
import tarfile
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxmill import scoring, sinks
from voxmill.audio import pcm
from voxmill.sources import audio_files, tables, tar_audio
from voxmill.streaming import segments as streaming


def tone(seconds, rate=16_000, channels=1, quiet=()):
    t = np.arange(int(seconds * rate)) / rate
    x = 0.5 * np.sin(2 * np.pi * 440 * t)
    for a, b in quiet:
        x[int(a * rate) : int(b * rate)] = 0
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.repeat((x * 32767).astype("<i2")[:, None], channels, 1).tobytes())
    return out.getvalue()


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    (root / "sub").mkdir()
    for name, data in {"a.wav": tone(1), "sub/b.WAV": tone(2, 8000, 2), "empty.wav": b"", "bad.wav": b"RIFFxxxxWAVE", "note.txt": b"x"}.items():
        (root / name).write_bytes(data)
    return root


def test_files(spark, tree):
    df = audio_files.audio_files(spark, str(tree), content=True)
    assert sorted(r.audio_id for r in df.collect()) == ["a", "bad", "sub/b"]
    assert audio_files.audio_files(spark, str(tree), max_files=2).count() == 2
    found = {r.audio_id: r for r in audio_files.decoded(df, ["audio_id"]).collect()}
    assert found["a"].num_sample == 16_000 and found["sub/b"].num_sample == 32_000 and found["bad"].error
    b = np.frombuffer(found["sub/b"].pcm, "<f4")[1000:-1000]
    assert np.abs(np.abs(np.fft.rfft(b)).argmax() / len(b) * 16_000 - 440) < 1
    segs = audio_files.decoded(df.where("audio_id = 'a'"), ["audio_id"]).select(F.lit("s").alias("seg_id"), "pcm", F.lit(0.25).alias("start_sec"), F.lit(0.5).alias("end_sec"))
    assert len(pcm.decode_wav(audio_files.slices(segs).first().wav)[0]) == 4000
    with pytest.raises(ValueError):
        audio_files.require_some(df.limit(0))


def test_transcoding_by_a_program(spark, tmp_path):
    program = tmp_path / "copy"
    program.write_text("#!/bin/sh\ncat\n")
    program.chmod(0o755)
    df = spark.createDataFrame([(1, bytearray(b"abc"))], "k int, content binary")
    assert bytes(audio_files.transcoded(df, ["k"], program=str(program)).first().wav) == b"abc"
    assert audio_files.transcoded(df, ["k"], program="/no/such/program").first().error == "FileNotFoundError"


def test_pcm():
    for channels in (1, 2):
        x, rate = pcm.decode_wav(tone(0.1, channels=channels))
        assert rate == 16_000 and len(x) == 1600
    assert np.allclose(pcm.decode_wav(pcm.encode_wav(x))[0], x, atol=1e-4)
    assert pcm.log_power(np.zeros(144_000)).shape == (901, 161) and (pcm.log_power(np.zeros(320)) == -12).all()
    assert [len(pcm.windows(np.ones(n * 16_000), p)) for n, p in ((4, "double"), (4, "tile"), (9, "tile"), (30, "double"))] == [8, 4, 1, 22]
    assert len(pcm.cut(np.arange(10), 0.25, 99, 10, "round")) == 8 and len(pcm.cut(np.arange(10), 0.29, 0.5, 10)) == 3
    frame = np.random.default_rng(0).normal(size=320)
    hann = np.array([0.5 - 0.5 * math.cos(2 * math.pi * k / 320) for k in range(320)])
    direct = abs(sum(frame[k] * hann[k] * np.exp(-2j * np.pi * 5 * k / 320) for k in range(320)) / hann.sum()) ** 2
    assert pcm.log_power(np.concatenate([np.zeros(0), frame]))[1, 5] == pytest.approx(math.log10(direct))


def test_tar(spark, tmp_path):
    path = str(tmp_path / "x.tar")
    with tarfile.open(path, "w") as tar:
        for name, data in (("one.wav", tone(1)), ("zero.wav", b""), ("bad.wav", b"junk"), ("n.txt", b"x"), ("two.WAV", tone(0.5))):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    found = {r.member: r for r in tar_audio.tar_audio(spark, path, content=True).collect()}
    assert set(found) == {"one.wav", "two.WAV", "bad.wav"} and found["one.wav"].num_sample == 16_000 and found["one.wav"].error is None
    assert found["bad.wav"].error == "not a WAV file" and found["bad.wav"].pcm is None
    assert found["one.wav"].wav_uuid == hashlib.sha256(f"{path}::one.wav".encode()).hexdigest()
    again = {r.wav_uuid: (r.pcm, r.error) for r in tar_audio.reread(tar_audio.tar_audio(spark, path)).collect()}
    assert all(again[r.wav_uuid] == (r.pcm, r.error) for r in found.values())


def test_segments_are_read_without_the_rest(spark, tmp_path):
    wav = tone(4, quiet=[(1, 2)])
    (tmp_path / "a.wav").write_bytes(wav)
    whole = pcm.decode_wav(wav)[0]
    rows = spark.createDataFrame([("s", str(tmp_path / "a.wav"), 0.5, 1.25), ("late", str(tmp_path / "a.wav"), 3.9, 9.0), ("none", str(tmp_path / "b.wav"), 0.0, 1.0)], "seg_id string, path string, start_sec double, end_sec double")
    found = {r.seg_id: r for r in audio_files.segment_samples(rows).collect()}
    assert np.allclose(np.frombuffer(found["s"].pcm, "<f4"), whole[8000:20000]) and np.allclose(np.frombuffer(found["late"].pcm, "<f4"), whole[62400:]) and found["none"].error


def test_polyphase_resampling():
    t = np.arange(44_100) / 44_100
    x = np.sin(2 * np.pi * 440 * t)
    y = pcm.resample_polyphase(x, 44_100)
    want = np.sin(2 * np.pi * 440 * np.arange(len(y)) / 16_000)
    assert len(y) == 16_000 and np.abs(y - want)[200:-200].max() < 2e-3
    high = pcm.resample_polyphase(np.sin(2 * np.pi * 12_000 * t), 44_100)
    assert np.abs(high[200:-200]).max() < 0.02  # beyond half of the new rate
    assert len(pcm.resample_polyphase(np.zeros(0), 8000)) == 0 and (pcm.resample_polyphase(np.ones(9), 16_000) == 1).all()


def graph(op: str) -> bytes:
    """A serialized graph y = op(x) of float tensors of any size, with the mean over all but the first axis for ReduceMean."""

    def field(number, value):
        key = number << 3 | (0 if isinstance(value, int) else 2)
        mark = bytes([key]) if key < 128 else bytes([key & 127 | 128, key >> 7])
        return mark + (bytes([value]) if isinstance(value, int) else bytes([len(value)]) + value)

    def tensor(name, axes):
        shape = field(2, b"".join(field(1, field(2, b"n%d" % k)) for k in range(axes)))
        return field(1, name) + field(2, field(1, field(1, 1) + shape))

    axes = field(5, field(1, b"axes") + field(8, 1) + field(20, 7)) + field(5, field(1, b"keepdims") + field(3, 0) + field(20, 2)) if op == "ReduceMean" else b""
    node = field(1, b"x") + field(2, b"y") + field(4, op.encode()) + axes
    body = field(1, node) + field(2, b"g") + field(11, tensor(b"x", 2)) + field(12, tensor(b"y", 1 if axes else 2))
    return field(1, 8) + field(7, body) + field(8, field(2, 13))


def test_graph_scorer(spark, tmp_path):
    (tmp_path / "mean.onnx").write_bytes(graph("ReduceMean"))
    df = spark.createDataFrame([(1, bytearray(np.array([1, 3], "<f4").tobytes())), (2, bytearray(np.array([5, 5, 5, 5], "<f4").tobytes())), (3, None)], "k int, pcm binary")
    scorer = scoring.Graph(str(tmp_path / "mean.onnx"), "level double", scoring.samples_of, lambda out, rows: {"level": [float(o[0][0]) for o in out]})
    found = {r.k: (r.level, r.score_error) for r in scoring.run_scorer(df, scorer, "record", drop=("pcm",)).collect()}
    assert found[1] == (2.0, None) and found[2] == (5.0, None) and found[3][0] is None and found[3][1]
    missing = scoring.Graph(str(tmp_path / "none.onnx"), "level double", scoring.samples_of, lambda out, rows: {})
    with pytest.raises(Exception, match="none.onnx"):
        scoring.run_scorer(df, missing).collect()


def test_scorers(spark):
    x = pcm.decode_wav(tone(3, quiet=[(1, 2)]))[0].astype("<f4").tobytes()
    df = spark.createDataFrame([(1, bytearray(x)), (2, None)], "k int, pcm binary")
    found = {r.k: r.segments for r in scoring.run_scorer(df, scoring.EnergyVad(), drop=("pcm",)).collect()}
    assert [(s.start_sec, s.end_sec) for s in found[1]] == [(0.0, 1.0), (2.0, 3.0)] and found[2] == []
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "k string").coalesce(1)
    scorer = scoring.Precomputed("t", "k", "v int", {"a": (1,), "c": (3,)})
    run = lambda policy: sorted((r.k, r.v, r.score_error) for r in scoring.run_scorer(keys, scorer, policy).collect())
    assert run("drop") == [("a", 1, None), ("c", 3, None)] and run("passthrough")[1] == ("b", None, None) and run("record")[1] == ("b", None, "'b'")
    with pytest.raises(Exception):
        run("fail")
    plan = scoring.run_scorer(keys, scorer).where("v > 1")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1


def test_tables_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("é", 1.5), ("b", None)], "t string, x double").coalesce(1)
    assert sinks.write_json_array(df, str(tmp_path / "a.json")) == 2
    assert json.loads((tmp_path / "a.json").read_text()) == [{"t": "é", "x": 1.5}, {"t": "b"}]
    assert sinks.write_json_array(df.limit(0), str(tmp_path / "e.json")) == 0 and json.loads((tmp_path / "e.json").read_text()) == []
    for name, rows in (("s1", df), ("s2", df.limit(0))):
        sinks.write_tsv(rows, str(tmp_path / name))
    assert tables.tsv(spark, str(tmp_path / "s1")).count() == 2 and tables.tsv(spark, str(tmp_path / "s2")).columns == ["t", "x"]
    assert tables.score_shards(spark, [str(tmp_path / "s1")]).columns == ["t", "x", "file", "block", "line"]
    (tmp_path / "l.jsonl").write_text('{"k": 1}\n{"k": \n{"k": 2}\n')
    assert sorted(r.k for r in tables.json_lines(spark, str(tmp_path / "l.jsonl"), "k int").collect()) == [1, 2]
    sinks.write_both(df, F.col("x") > 1, str(tmp_path / "all"), str(tmp_path / "kept"))
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 1
    assert sinks.write_once(df, str(tmp_path / "o")).count() == 2 and sinks.write_once(df.limit(1), str(tmp_path / "o")).count() == 2
    clips = spark.createDataFrame([("u1", bytearray(b"x"))], "uid string, wav binary")
    assert sinks.write_clips(clips, str(tmp_path / "clips")).first().bytes == 1
    assert sinks.write_vocab(spark.createDataFrame([("a", 0)], "token string, id int"), str(tmp_path / "v.json")) == 1
    sinks.write_splits(df.withColumn("split", F.lit("dev")), str(tmp_path / "splits"))
    assert (tmp_path / "splits" / "split=dev").exists()


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    put = lambda name, rows: (src / name).write_text("\n".join(json.dumps(dict(zip(("wav_uuid", "seg_start", "seg_end", "lang", "lang_prob", "mos_ovr"), r))) for r in rows))
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    run = lambda: streaming.run_available(streaming.gate_stream(streaming.segment_stream(spark, str(src)), ("zh",)), out, mark)
    put("1.json", [("a", 5.0, 6.0, "en", 0.9, 3.0), ("a", 0.0, 1.0, "zh", 0.95, 3.0), ("b", 0.0, 1.0, "en", 0.99, 3.0)])
    run()
    put("2.json", [("a", 9.0, 10.0, "en", 0.1, 3.0), ("b", 2.0, 3.0, "zh", 0.99, 3.0)])
    run()
    run()
    rows = spark.read.parquet(out).orderBy("seg_start").collect()
    assert [(r.wav_uuid, r.seg_start, r.lang) for r in rows] == [("a", 0.0, "zh"), ("a", 5.0, "zh"), ("a", 9.0, "zh")]
    batch = streaming.gate_batch(spark.read.schema(streaming.SEGMENT).json(str(src)), ("zh",))
    assert sorted(r.seg_start for r in batch.collect()) == [0.0, 5.0, 9.0]

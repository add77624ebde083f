"""All named plans of the engine with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, numbers, text
from ..materialize import with_row_number
from ..operators import export, language, merge, quality, segments, speaker, training
from . import proxies
from .proxies import SEGMENTS, UTTERANCES, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

FLOORS = quality.QualityFloors(min_dur=3, max_dur=30, min_ovr=2.5, min_sig=2.0, min_bak=2.0)
QUANTILE = quality.QualityFloors(min_dur=3, max_dur=30, min_sig=2.0, min_bak=2.0, keep_quantile=0.7)
GATE = training.TrainGate(targets=("en", "fr"), min_lang_prob=0.5, min_ovr=1.5)
#: White space and listed marks as RE2 character classes, written out for the SQL.
SPACES = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
MARKS = r"[!\"''(),.:;?\[\]—…、。《》【】！（），：；？]"


def plan(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# Segments


@plan(f"WITH {SEGMENTS} SELECT seg_id, audio_id, path, CAST(seg_idx AS INT) AS seg_idx, start_sec, end_sec, duration_sec FROM segments")
def explode_segments(spark, sf_dir):
    nested = segments.nest_segments(proxies.segments(spark, sf_dir), fields=("start_sec", "end_sec", "duration_sec"))
    return segments.explode_segments(nested)


@plan(f"""WITH {SEGMENTS} SELECT audio_id, min(path) AS path, count(*) AS num_segments, string_agg(seg_id, ',' ORDER BY seg_idx) AS seg_ids,
  CAST(sum(round(duration_sec * 1000)) AS BIGINT) AS total_ms FROM segments GROUP BY audio_id""")
def nest_segments(spark, sf_dir):
    nested = segments.nest_segments(proxies.segments(spark, sf_dir))
    total = F.aggregate("segments", F.lit(0).cast("bigint"), lambda t, s: t + numbers.millis(s["duration_sec"]))
    return nested.select("audio_id", "path", "num_segments", F.array_join(F.transform("segments", lambda s: s["seg_id"]), ",").alias("seg_ids"), total.alias("total_ms"))


@plan(f"""WITH {SEGMENTS}, pieces AS (
  SELECT seg_id, start_sec AS s0, end_sec AS e0, end_sec - start_sec AS dur, unnest(range(0, CASE WHEN end_sec - start_sec > 12 THEN CAST(ceil((end_sec - start_sec) / 12) AS BIGINT) ELSE 1 END)) AS piece
  FROM segments), cut AS (
  SELECT seg_id, piece, s0 + piece * 12.0::DOUBLE AS s, least(CASE WHEN dur > 12 THEN s0 + (piece + 1) * 12.0::DOUBLE ELSE e0 END, e0) AS e FROM pieces)
  SELECT seg_id, CAST(piece AS INT) AS piece, round(s, 3) AS start_sec, round(e, 3) AS end_sec, round(e - s, 3) AS duration_sec FROM cut WHERE e - s >= 2.5""")
def vad_split_long(spark, sf_dir):
    out = segments.split_long(proxies.segments(spark, sf_dir), min_dur=2.5, max_dur=12)
    return out.select("seg_id", "piece", "start_sec", "end_sec", "duration_sec")


@plan(f"WITH {SEGMENTS} SELECT seg_id, start_sec, end_sec FROM segments WHERE end_sec - start_sec BETWEEN 5 AND 30")
def vad_duration_filter(spark, sf_dir):
    return segments.duration_gate(proxies.segments(spark, sf_dir), 5, 30).select("seg_id", "start_sec", "end_sec")


_GAP = 6 * 3_600_000_000


@plan(f"""WITH t AS (SELECT user_id, event_id, epoch_us(ts) AS us FROM events), m AS (
  SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) > {_GAP} THEN 1 ELSE 0 END AS brk FROM t), i AS (
  SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS island FROM m)
  SELECT user_id, CAST(island AS BIGINT) AS island, min(us) AS first_us, max(us) AS last_us, count(*) AS n FROM i GROUP BY ALL""")
def vad_gap_merge(spark, sf_dir):
    frames = table(spark, sf_dir, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return segments.gap_merge(frames, "user_id", ["us", "event_id"], "us", _GAP)


# Quality


@plan(f"""WITH {SEGMENTS} SELECT seg_id, audio_id, start_sec, end_sec, duration_sec, mos_ovr FROM segments
  WHERE duration_sec BETWEEN 3 AND 30 AND end_sec > start_sec AND mos_sig >= 2.0 AND mos_bak >= 2.0 AND mos_ovr >= 2.5 ORDER BY audio_id, start_sec, end_sec""")
def dnsmos_filter_basic(spark, sf_dir):
    kept = quality.quality_filter(proxies.segments(spark, sf_dir), FLOORS)
    return quality.in_order(kept.select("seg_id", "audio_id", "start_sec", "end_sec", "duration_sec", "mos_ovr"))


@plan(f"""WITH {SEGMENTS}, ok AS (SELECT * FROM segments WHERE duration_sec BETWEEN 3 AND 30 AND end_sec > start_sec AND mos_sig >= 2.0 AND mos_bak >= 2.0)
  SELECT seg_id, audio_id, start_sec, end_sec, duration_sec, mos_ovr FROM ok WHERE mos_ovr >= (SELECT quantile_cont(mos_ovr, {1 - 0.7}) FROM ok)""")
def dnsmos_filter_quantile(spark, sf_dir):
    return quality.quality_filter(proxies.segments(spark, sf_dir), QUANTILE).select("seg_id", "audio_id", "start_sec", "end_sec", "duration_sec", "mos_ovr")


@plan(f"""WITH {SEGMENTS} SELECT seg_id, round(mos_ovr, 3) AS mos_ovr FROM segments WHERE NOT (round(mos_ovr, 3) < 2.0 OR round(mos_sig, 3) < 2.0 OR round(mos_bak, 3) < 3.5)""")
def mos_gate(spark, sf_dir):
    return quality.inline_gate(proxies.segments(spark, sf_dir)).select("seg_id", "mos_ovr")


_PADDED = "CASE WHEN n >= 144000 THEN n ELSE n * {} END"
_DOUBLE = _PADDED.format("list_filter([1, 2, 4, 8, 16, 32, 64, 128, 256, 512, 1024], lambda c: n * c >= 144000)[1]")
_TILE = _PADDED.format("CAST(ceil(144000 / n) AS BIGINT)")


@plan(f"""WITH {SEGMENTS}, s AS (SELECT seg_id, CAST(duration_sec * 16000 AS BIGINT) AS n FROM segments), p AS (SELECT seg_id, CAST({_DOUBLE} AS BIGINT) AS d, CAST({_TILE} AS BIGINT) AS t FROM s)
  SELECT seg_id, d AS padded_double, greatest(d // 16000 - 8, 1) AS hops_double, t AS padded_tile, greatest(t // 16000 - 8, 1) AS hops_tile FROM p""")
def dnsmos_window_plan(spark, sf_dir):
    n = (F.col("duration_sec") * quality.RATE).cast("bigint")
    rows = proxies.segments(spark, sf_dir).select("seg_id", quality.padded_samples(n, "double").alias("padded_double"), quality.padded_samples(n, "tile").alias("padded_tile"))
    return rows.select("seg_id", "padded_double", quality.hops(F.col("padded_double")).alias("hops_double"), "padded_tile", quality.hops(F.col("padded_tile")).alias("hops_tile"))


@plan(f"""WITH {SEGMENTS}, s AS (SELECT seg_id, mos_ovr, CAST(duration_sec * 16000 AS BIGINT) AS n FROM segments), p AS (SELECT seg_id, mos_ovr, CAST({_TILE} AS BIGINT) AS t FROM s),
  w AS (SELECT seg_id, (CAST(round(mos_ovr * 1000) AS BIGINT) + 37 * unnest(range(0, greatest(t // 16000 - 8, 1)))) % 4001 AS m FROM p)
  SELECT seg_id, count(*) AS windows, round(avg(m), 6) AS mean_milli FROM w GROUP BY seg_id""")
def mos_window_mean(spark, sf_dir):
    rows = proxies.segments(spark, sf_dir)
    windows = quality.window_plan(rows.withColumn("m", numbers.millis(F.col("mos_ovr"))), "tile", keep=("m",))
    scores = windows.withColumn("m", (F.col("m") + 37 * F.col("hop")) % 4001)
    counted = quality.window_mean(scores.withColumn("windows", F.lit(1)), "seg_id", ["m"]).join(scores.groupBy("seg_id").agg(F.count("*").alias("windows")), "seg_id")
    return counted.select("seg_id", "windows", F.round("m", 6).alias("mean_milli"))


@plan(f"""WITH {SEGMENTS} SELECT seg_id, round(0.9651228012789437::DOUBLE + 0.6592637550310214::DOUBLE * mos_sig + 0.07572372955623895::DOUBLE * mos_sig * mos_sig, 6) AS sig,
  round(-3.7334600111017817::DOUBLE + 2.700114234092929::DOUBLE * mos_bak - 0.17213329073409228::DOUBLE * mos_bak * mos_bak, 6) AS bak,
  round(0.8924546794696789::DOUBLE + 0.6609981731940616::DOUBLE * mos_ovr + 0.0760026953024318::DOUBLE * mos_ovr * mos_ovr, 6) AS ovr FROM segments""")
def mos_calibrate(spark, sf_dir):
    return proxies.segments(spark, sf_dir).select("seg_id", *(F.round(numbers.calibrate(F.col(f"mos_{k}"), k), 6).alias(k) for k in ("sig", "bak", "ovr")))


# Language

_STATUS = "CASE WHEN lang IS NULL THEN 'lid_error:none' WHEN duration_sec < 1 THEN 'too_short_for_lid' ELSE 'ok' END"
_DECISION = f"""CASE WHEN starts_with({_STATUS}, 'lid_error') THEN 'lid_error' WHEN {_STATUS} = 'too_short_for_lid' THEN 'too_short_for_lid'
  WHEN NOT (lower(lang) IN ('en', 'fr')) THEN 'not_target_lang' WHEN lang_prob < 0.5 THEN 'low_lang_prob' ELSE 'keep' END"""


def _decided(spark, sf_dir):
    rows = proxies.utterances(spark, sf_dir)
    status = F.when(F.col("lang").isNull(), "lid_error:none").when(F.col("duration_sec") < 1, "too_short_for_lid").otherwise("ok")
    return language.lid_decision(rows.withColumn("status", status), ["en,fr", "en"], 0.5)


@plan(f"WITH {UTTERANCES} SELECT doc_id, lang, lang_prob, {_DECISION} AS lang_keep_reason FROM utterances")
def lid_decision(spark, sf_dir):
    return _decided(spark, sf_dir).select("doc_id", "lang", "lang_prob", "lang_keep_reason")


@plan(f"""WITH {UTTERANCES}, d AS (SELECT {_DECISION} AS r FROM utterances)
  SELECT count(*) AS n, CAST(count(*) FILTER (r = 'keep') AS BIGINT) AS kept, round(avg(CASE WHEN r = 'keep' THEN 1 ELSE 0 END), 6) AS ratio FROM d""")
def keep_ratio(spark, sf_dir):
    return language.keep_ratio(_decided(spark, sf_dir))


@plan(f"""WITH {UTTERANCES} SELECT audio_id, doc_id, lang, duration_sec FROM utterances
  QUALIFY row_number() OVER (PARTITION BY audio_id ORDER BY coalesce(duration_sec, 0) DESC, doc_id) = 1""")
def lid_probe_longest(spark, sf_dir):
    return language.probe_longest(proxies.utterances(spark, sf_dir).select("audio_id", "doc_id", "lang", "duration_sec"), "audio_id", "duration_sec", "doc_id")


@plan(f"""WITH {UTTERANCES}, p AS (SELECT audio_id, lang, lang_prob FROM utterances WHERE duration_sec BETWEEN 0.1 AND 15 AND lang IS NOT NULL QUALIFY row_number() OVER (PARTITION BY audio_id ORDER BY doc_id) = 1)
  SELECT u.doc_id, audio_id, p.lang, p.lang_prob FROM utterances u JOIN p USING (audio_id) WHERE p.lang IN ('en', 'fr') AND p.lang_prob >= 0.5""")
def lid_gate_first_segment(spark, sf_dir):
    rows = proxies.utterances(spark, sf_dir).select("doc_id", "audio_id", "lang", "lang_prob", "duration_sec")
    usable = F.col("duration_sec").between(0.1, 15) & F.col("lang").isNotNull()
    return language.gate_by_first(rows, "audio_id", "doc_id", ["en", "fr"], 0.5, usable).select("doc_id", "audio_id", "lang", "lang_prob")


# Speakers


def _voices(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").withColumn("file_id", F.col("vec_id") % 50)


_CENTROID = """v AS (SELECT vec_id, {key} AS k, unnest(embedding)::DOUBLE AS x, unnest(range(0, len(embedding))) AS place, sqrt(list_sum(list_transform(embedding, lambda e: e::DOUBLE * e::DOUBLE))) + 1e-12 AS n FROM embeddings),
  m AS (SELECT k, place, avg(x / n) AS x, count(*) AS c FROM v GROUP BY ALL), {name} AS (SELECT k, place, x / (sqrt(sum(x * x) OVER (PARTITION BY k)) + 1e-12) AS x, c FROM m)"""


def _centroid_sql(key: str, label: str) -> str:
    return f"WITH {_CENTROID.format(key=key, name='r')} SELECT k AS {label}, c AS n, CAST(place AS INT) AS place, round(x, 6) AS x FROM r"


def _flat(df, key):
    return df.select(key, "n", F.posexplode("centroid").alias("place", "x")).withColumn("x", F.round("x", 6))


@plan(_centroid_sql("label", "label"))
def speaker_centroid(spark, sf_dir):
    return _flat(speaker.centroids(_voices(spark, sf_dir), "label"), "label")


@plan(_centroid_sql("vec_id % 50", "file_id"))
def file_centroid(spark, sf_dir):
    return _flat(speaker.centroids(_voices(spark, sf_dir), "file_id"), "file_id")


def _similar(spark, sf_dir):
    rows = _voices(spark, sf_dir)
    return speaker.similarities(rows, speaker.centroids(rows, "label"), speaker.centroids(rows, "file_id"), "label", "file_id")


def _sims_sql() -> str:
    two = _CENTROID.format(key="label", name="rs") + ", " + _CENTROID.format(key="vec_id % 50", name="rf").replace("v AS (", "v2 AS (").replace("FROM v GROUP", "FROM v2 GROUP").replace("m AS (", "m2 AS (").replace("FROM m)", "FROM m2)")
    return f"""WITH {two}, e AS (SELECT vec_id, k AS label, vec_id % 50 AS file_id, place, x / n AS x FROM v),
  s AS (SELECT e.vec_id, e.label, e.file_id, sum(e.x * rs.x) / ((sqrt(sum(e.x * e.x)) + 1e-12) * (sqrt(sum(rs.x * rs.x)) + 1e-12)) AS s, sum(e.x * rf.x) / ((sqrt(sum(e.x * e.x)) + 1e-12) * (sqrt(sum(rf.x * rf.x)) + 1e-12)) AS f
    FROM e JOIN rs ON rs.k = e.label AND rs.place = e.place JOIN rf ON rf.k = e.file_id AND rf.place = e.place GROUP BY ALL)"""


@plan(_sims_sql() + " SELECT vec_id, label, file_id, round(s, 4) AS sim_spk, round(f, 4) AS sim_file FROM s")
def speaker_similarity(spark, sf_dir):
    return _similar(spark, sf_dir).select("vec_id", "label", "file_id", F.round("sim_spk", 4).alias("sim_spk"), F.round("sim_file", 4).alias("sim_file"))


@plan(_sims_sql() + """ SELECT vec_id, CASE WHEN (vec_id % 40) / 4.0 < 1 THEN 'drop_short' WHEN s < 0.6 AND f < 0.3 THEN 'drop_spk_and_file' WHEN s < 0.6 THEN 'drop_spk' WHEN f < 0.3 THEN 'drop_file' ELSE 'keep' END AS keep_reason FROM s""")
def speaker_decision(spark, sf_dir):
    return speaker.decisions(_similar(spark, sf_dir), F.col("vec_id") % 40 / F.lit(4.0), F.col("embedding"), min_file=0.3).select("vec_id", "keep_reason")


_RAW_SPEAKER = "CASE WHEN label % 4 = 0 THEN 'S' || label ELSE 'UNKNOWN' END"
_UNIT = "list_transform({v}, lambda e: e / (sqrt(list_sum(list_transform({v}, lambda y: y * y))) + 1e-12))"


@plan(f"""WITH RECURSIVE e AS (SELECT vec_id, vec_id % 50 AS file_id, {_RAW_SPEAKER} AS spk, list_transform(embedding, lambda x: x::DOUBLE) AS d FROM embeddings),
  u AS (SELECT file_id, vec_id, row_number() OVER (PARTITION BY file_id ORDER BY vec_id) AS n, {_UNIT.format(v='d')} AS v FROM e WHERE spk = 'UNKNOWN'),
  g AS (SELECT file_id, vec_id, n, [v] AS held, 1::BIGINT AS k FROM u WHERE n = 1 UNION ALL
    SELECT file_id, vec_id, n, CASE WHEN hit THEN list_transform(held, lambda c, i: CASE WHEN i = best THEN {_UNIT.format(v='moved')} ELSE c END) ELSE list_append(held, v) END,
      CASE WHEN hit THEN best ELSE len(held) + 1 END FROM (
      SELECT *, list_max(sims) >= 0.74 AS hit, list_position(sims, list_max(sims))::BIGINT AS best, list_transform(list_zip(held[list_position(sims, list_max(sims))], v), lambda z: z[1] + z[2]) AS moved FROM (
        SELECT u.*, g.held, list_transform(g.held, lambda c: list_dot_product(c, u.v)) AS sims FROM g JOIN u ON u.file_id = g.file_id AND u.n = g.n + 1)))
  SELECT file_id, vec_id, 'AUTO_' || file_id || '_p' || printf('%03d', k - 1) AS spk_final FROM g UNION ALL SELECT file_id, vec_id, spk FROM e WHERE spk <> 'UNKNOWN'""")
def speaker_greedy_cluster(spark, sf_dir):
    rows = _voices(spark, sf_dir).withColumn("spk", F.expr(_RAW_SPEAKER))
    return speaker.greedy_clusters(rows, "file_id", "vec_id", "spk")


# Merging and resuming


def _score_files(rows):
    """Two files of scores, made in one pass over the segments."""
    score = lambda hit, mos, file: F.when(hit, F.struct(mos.alias("mos_ovr"), F.lit(file).alias("file"), F.col("seg_idx").alias("line")))
    files = F.array(score(F.col("seg_idx") % 5 != 0, F.col("mos_ovr"), 0), score(F.col("seg_idx") % 2 == 0, F.col("mos_ovr") + 1, 1))
    return rows.select("seg_id", "audio_id", F.explode(files).alias("s")).where("s IS NOT NULL").select("seg_id", "audio_id", "s.*")


@plan(f"""WITH {SEGMENTS}, scores AS (SELECT seg_id FROM segments WHERE seg_idx % 5 <> 0 UNION ALL SELECT seg_id FROM segments WHERE seg_idx % 2 = 0)
  SELECT (SELECT count(*) FROM segments) AS expected, (SELECT count(*) FROM segments SEMI JOIN scores USING (seg_id)) AS written, (SELECT count(*) FROM segments ANTI JOIN scores USING (seg_id)) AS missing,
    (SELECT count(*) - count(DISTINCT seg_id) FROM scores) AS duplicates""")
def merge_score_counts(spark, sf_dir):
    rows = proxies.segments(spark, sf_dir)
    return merge.merge_counts(rows, _score_files(rows), ("audio_id", "seg_id"))


@plan(f"""WITH {SEGMENTS}, scores AS (SELECT seg_id, mos_ovr, 0 AS file FROM segments WHERE seg_idx % 5 <> 0 UNION ALL SELECT seg_id, mos_ovr + 1, 1 FROM segments WHERE seg_idx % 2 = 0),
  last AS (SELECT seg_id, mos_ovr FROM scores QUALIFY row_number() OVER (PARTITION BY seg_id ORDER BY file DESC) = 1)
  SELECT s.seg_id, s.audio_id, s.seg_idx, CAST(round(last.mos_ovr * 1000) AS BIGINT) AS mos_milli FROM segments s JOIN last USING (seg_id) ORDER BY audio_id, seg_idx""")
def merge_scores_in_order(spark, sf_dir):
    rows = proxies.segments(spark, sf_dir)
    out = merge.merge_scores(rows.select("seg_id", "audio_id", "seg_idx"), _score_files(rows), ["file", "line"], keys=("audio_id", "seg_id"))
    return out.select("seg_id", "audio_id", "seg_idx", numbers.millis(F.col("mos_ovr")).alias("mos_milli"))


@plan(f"""WITH {SEGMENTS} SELECT seg_id, audio_id, CASE WHEN seg_idx % 4 = 0 THEN '' ELSE 't' || seg_idx END AS text, CASE WHEN seg_idx % 4 = 0 THEN 'missing_from_shards' END AS error FROM segments""")
def merge_asr_shards(spark, sf_dir):
    rows = proxies.segments(spark, sf_dir)
    result = lambda hit, said, file: F.when(hit, F.struct(said.alias("text"), F.lit(None).cast("string").alias("error"), F.lit(file).alias("file"), F.col("seg_idx").alias("line")))
    has, again = F.col("seg_idx") % 4 != 0, F.col("seg_idx") % 3 == 0
    shards = F.array(result(has, F.concat(F.lit("t"), F.col("seg_idx").cast("string")), 1), result(has & again, F.lit("older"), 0))
    found = rows.select("audio_id", "seg_id", "start_sec", "end_sec", F.explode(shards).alias("s")).where("s IS NOT NULL").select("audio_id", "seg_id", "start_sec", "end_sec", "s.*")
    out = merge.merge_transcripts(rows.select("seg_id", "audio_id", "start_sec", "end_sec"), found, ["file", "line"])
    return out.select("seg_id", "audio_id", "text", "error")


@plan("""SELECT doc_id, CAST(quality AS BIGINT) AS value, 'cached' AS status FROM labels SEMI JOIN documents USING (doc_id) UNION ALL SELECT doc_id, n_chars % 2, 'computed' FROM documents ANTI JOIN labels USING (doc_id)""")
def cache_lookaside(spark, sf_dir):
    cache = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("bigint").alias("value"))
    return merge.look_aside(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), cache, "doc_id", lambda m: m.select("doc_id", (F.col("n_chars") % 2).alias("value")))[0]


@plan("SELECT doc_id, lang, n_chars FROM documents ANTI JOIN labels USING (doc_id)")
def resume_anti_join(spark, sf_dir):
    return merge.remaining(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), table(spark, sf_dir, "labels"), "doc_id")


@plan("""SELECT doc_id, CAST(quality AS BIGINT) AS value FROM labels UNION ALL SELECT doc_id, n_chars FROM documents ANTI JOIN labels USING (doc_id)""")
def resume_union(spark, sf_dir):
    done = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("bigint").alias("value"))
    return merge.resume_union(done, table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("value")), "doc_id", repeated=False)


@plan("""SELECT path, doc_id FROM (SELECT '/corpus/' || source || '/' || doc_id || '.wav' AS path, doc_id FROM documents) ORDER BY path LIMIT 100""")
def limit_files(spark, sf_dir):
    path = F.concat(F.lit("/corpus/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".wav"))
    return table(spark, sf_dir, "documents").select(path.alias("path"), "doc_id").orderBy("path").limit(100)


_NUMBERED = "n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row FROM documents), c AS (SELECT count(*) AS total FROM documents)"


@plan(f"WITH {_NUMBERED} SELECT doc_id, row, CASE WHEN total // 7 = 0 THEN 6 ELSE least(row // (total // 7), 6) END AS shard FROM n, c")
def shard_contiguous(spark, sf_dir):
    rows = with_row_number(table(spark, sf_dir, "documents").select("doc_id"), [F.col("doc_id")])
    return rows.withColumn("shard", merge.contiguous_shard(F.col("row"), rows.count(), 7))


@plan(f"WITH {_NUMBERED} SELECT doc_id, row, row % 8 AS shard FROM n")
def shard_modulo(spark, sf_dir):
    rows = with_row_number(table(spark, sf_dir, "documents").select("doc_id"), [F.col("doc_id")])
    return rows.withColumn("shard", merge.modulo_shard(F.col("row"), 8))


@plan("WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row FROM documents) SELECT doc_id, row FROM n WHERE row >= 50 AND row < 150")
def file_index_slice(spark, sf_dir):
    rows = with_row_number(table(spark, sf_dir, "documents").select("doc_id"), [F.col("doc_id")])
    return rows.where("row >= 50 AND row < 150")


# Training tables

_SQL_NORM = f"trim(regexp_replace(lower(regexp_replace(coalesce(text, ''), '{MARKS}', '', 'g')), '[{SPACES}]+', ' ', 'g'))"
_REASON = f"""CASE WHEN {_SQL_NORM} = '' THEN 'no_text' WHEN coalesce(wav, '') = '' THEN 'no_wav' WHEN duration_sec < 1 OR duration_sec > 30 THEN 'duration'
  WHEN lang_prob < 0.5 OR coalesce(lang, '') NOT IN ('en', 'fr') THEN 'language' WHEN coalesce(mos_ovr < 1.5, false) THEN 'mos' ELSE 'keep' END"""


def _items(spark, sf_dir):
    none = F.lit(None).cast("double")
    return proxies.utterances(spark, sf_dir).withColumns({"mos_sig": none, "mos_bak": none, "key": F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("k"), F.col("doc_id").cast("string"))), "source_path": F.col("audio_id")})


@plan(f"WITH {UTTERANCES} SELECT {_REASON} AS reason, count(*) AS n FROM utterances GROUP BY 1")
def train_filter_reasons(spark, sf_dir):
    return training.reason_counts(_items(spark, sf_dir), GATE)


@plan(f"""WITH {UTTERANCES} SELECT CASE WHEN doc_id % 2 = 0 THEN 'k' || doc_id ELSE printf('utt_%08d', doc_id) END AS key, wav, {_SQL_NORM} AS text, lang, duration_sec, mos_ovr, nullif(lang_prob, 0) AS lang_prob, audio_id AS source_path
  FROM utterances WHERE {_REASON} = 'keep'""")
def train_rows(spark, sf_dir):
    return training.training_rows(_items(spark, sf_dir), GATE, "doc_id").drop("mos_sig", "mos_bak", "sim_spk")


_SPLIT = """h AS (SELECT *, row_number() OVER (ORDER BY sha256('20260605:' || doc_id)) - 1 AS r FROM documents), c AS (SELECT greatest(1, CAST(floor(count(*) * 0.02) AS BIGINT)) AS t FROM documents),
  split AS (SELECT doc_id, n_chars, text, CASE WHEN r < t THEN 'test' WHEN r < 2 * t THEN 'dev' ELSE 'train' END AS split FROM h, c)"""


def _split(spark, sf_dir, *cols):
    return training.seeded_split(table(spark, sf_dir, "documents").select("doc_id", *cols), "doc_id")


@plan(f"WITH {_SPLIT} SELECT doc_id, split FROM split")
def seeded_split(spark, sf_dir):
    return _split(spark, sf_dir)


@plan(f"WITH {_SPLIT} SELECT split, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS seconds, round(sum(n_chars) / 3600, 6) AS hours FROM split GROUP BY split")
def split_hours(spark, sf_dir):
    return training.split_hours(_split(spark, sf_dir, "n_chars"), "n_chars")


@plan(f"""WITH {_SPLIT}, ch AS (SELECT doc_id, unnest(string_split(text, '')) AS token, unnest(range(0, len(text))) AS pos FROM split WHERE split = 'train'),
  k AS (SELECT token, count(*) AS n, min((doc_id, pos)) AS first FROM ch WHERE token NOT IN ('', ' ') GROUP BY token)
  SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, first) + 2 AS INT) AS id FROM k UNION ALL SELECT * FROM (VALUES ('<pad>', NULL, 0), ('<unk>', NULL, 1), ('|', NULL, 2))""")
def char_vocab(spark, sf_dir):
    return training.char_vocab(_split(spark, sf_dir, "text").where("split = 'train'"), "text", "doc_id")


@plan("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text WHEN doc_id % 3 = 1 THEN 'said ' || doc_id ELSE text END AS text, CASE WHEN doc_id % 2 = 0 THEN n_chars / 10.0::DOUBLE ELSE n_chars / 100.0::DOUBLE END AS duration_sec,
  CASE WHEN doc_id % 5 = 0 THEN 'xx' ELSE coalesce(lang, '') END AS lang, CASE WHEN doc_id % 2 = 0 THEN 'w' || doc_id ELSE 'k' || doc_id END AS key, CASE WHEN doc_id % 7 = 0 THEN '/t.tar' ELSE source END AS source_path,
  '/x.wav' AS wav, NULL::DOUBLE AS lang_prob, NULL::DOUBLE AS mos_ovr, NULL::DOUBLE AS mos_sig, NULL::DOUBLE AS mos_bak FROM documents""")
def label_items(spark, sf_dir):
    d, odd = table(spark, sf_dir, "documents"), F.col("doc_id") % 2 == 1
    said = F.create_map(F.lit("m1"), F.lit(""), F.lit("m2"), F.when(F.col("doc_id") % 3 == 1, F.concat(F.lit("said "), F.col("doc_id").cast("string"))).otherwise(F.lit("")))
    labels = d.select(
        "doc_id", "text", "lang", F.when(F.col("doc_id") % 3 != 0, said).alias("transcribe"), F.when(odd, F.lit(0.0)).otherwise(F.col("n_chars") / F.lit(10.0)).alias("duration"),
        (F.col("n_chars") / F.lit(100.0)).alias("duration_sec"), F.when(F.col("doc_id") % 5 == 0, "xx").otherwise("").alias("text_lang"), F.when(~odd, F.concat(F.lit("w"), F.col("doc_id").cast("string"))).alias("wav_uuid"),
        F.concat(F.lit("k"), F.col("doc_id").cast("string")).alias("key"), F.when(F.col("doc_id") % 7 == 0, "/t.tar").alias("tar_path"), F.col("source").alias("source_path"), F.lit("/x.wav").alias("wav"),
    )
    return training.label_items(labels).drop("transcribe", "duration", "text_lang", "wav_uuid", "tar_path")


@plan()
def shuffled_split(spark, sf_dir):
    return training.shuffled_split(table(spark, sf_dir, "documents").select("doc_id"), [F.col("doc_id")])


# Labels


@plan(f"""WITH {SEGMENTS} SELECT printf('%08d', CAST(seg_idx AS BIGINT)) || '_' || audio_id || '_' || seg_id AS uid, audio_id, seg_id,
  'audio/' || printf('%08d', CAST(seg_idx AS BIGINT)) || '_' || audio_id || '_' || seg_id || '.wav' AS path, 'w ' || seg_idx AS text, path AS source_path, start_sec, end_sec, duration_sec, 'en' AS lang, 0.95::DOUBLE AS lang_prob, mos_ovr
  FROM segments WHERE seg_idx % 3 <> 0""")
def label_export(spark, sf_dir):
    said = F.when(F.col("seg_idx") % 3 != 0, F.concat(F.lit(" w "), F.col("seg_idx").cast("string"), F.lit(" "))).otherwise(F.lit("  "))
    rows = proxies.segments(spark, sf_dir).withColumns({"text": said, "lang": F.lit("en"), "lang_prob": F.lit(0.95)}).drop("mos_sig", "mos_bak")
    return export.export_labels(rows, "seg_idx")


@plan(f"""WITH {SEGMENTS} SELECT sha256(sha256('/data/x.tar::' || path) || '::' || printf('%.4f', round(start_sec, 4))) AS wav_uuid, start_sec AS seg_start, end_sec AS seg_end, round(end_sec - start_sec, 4) AS duration,
  CAST(round(end_sec - start_sec, 4) * 16000 AS BIGINT) AS num_sample, 'said ' || seg_idx AS said FROM segments""")
def tar_label_record(spark, sf_dir):
    token = F.struct(F.lit(" a ").alias("token"), F.col("start_sec").alias("start"), F.col("end_sec").alias("end"))
    rows = proxies.segments(spark, sf_dir).select(
        F.lit("/data/x.tar").alias("tar_path"), F.lit(None).cast("string").alias("wav"), ids.member_uuid(F.lit("/data/x.tar"), F.col("path")).alias("wav_uuid"), F.lit(512).cast("bigint").alias("wav_offset"),
        F.lit(1).cast("bigint").alias("wav_size"), F.col("start_sec").alias("seg_start"), F.col("end_sec").alias("seg_end"), F.lit("en").alias("text_lang"),
        F.concat(F.lit("said "), F.col("seg_idx").cast("string")).alias("text"), F.array(token).alias("tokens"),
    )
    return export.tar_records(rows, "m").select("wav_uuid", "seg_start", "seg_end", "duration", "num_sample", F.col("transcribe")["m"].alias("said"))


@plan(f"""WITH t AS (SELECT conv_id, turn, trim(w) AS token, p FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS w, unnest(range(0, len(string_split(text, ' ')))) AS p FROM conversations))
  SELECT conv_id, turn, regexp_replace(token, '^[{SPACES}]+|[{SPACES}]+$', '', 'g') AS token, round(p / 8.0, 3) AS start_sec, round((p + 1) / 8.0, 3) AS end_sec FROM t WHERE regexp_replace(token, '^[{SPACES}]+|[{SPACES}]+$', '', 'g') <> ''""")
def token_timestamps(spark, sf_dir):
    words = F.transform(F.split("text", " "), lambda w, p: F.struct(w.alias("token"), (p / F.lit(8.0)).alias("start"), ((p + 1) / F.lit(8.0)).alias("end")))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(export.clean_tokens(words)).alias("t"))
    return rows.select("conv_id", "turn", F.col("t.token").alias("token"), F.col("t.start").alias("start_sec"), F.col("t.end").alias("end_sec"))


# Scalar functions


@plan(f"SELECT doc_id, {_SQL_NORM} AS text FROM documents")
def norm_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.norm_text(F.col("text")).alias("text"))


@plan("""SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'na') AS squeezed, regexp_replace(url, '[^A-Za-z0-9_.-]', '_', 'g') AS plain FROM pages""")
def safe_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.safe_name(F.col("url")).alias("squeezed"), text.safe_name(F.col("url"), squeeze=False).alias("plain"))


@plan("SELECT page_id, left(regexp_replace(trim(left(html, 200)), '[^A-Za-z0-9_.-]+', '_', 'g'), 80) AS name FROM pages")
def sanitize_id(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.sanitize_id(F.left("html", F.lit(200))).alias("name"))


_AUDIO = """CASE p_partkey % 9 WHEN 0 THEN 'S' || p_size || p_partkey || '-x' WHEN 1 THEN 'a id' || (p_partkey * 37) WHEN 2 THEN 'Spk_' || p_size WHEN 3 THEN '' WHEN 4 THEN p_size || ''
  WHEN 5 THEN p_name WHEN 6 THEN 'speaker-' || p_partkey || ' take' WHEN 7 THEN (p_partkey * 13) || '_' || (p_size * 101) ELSE 'x' || (p_partkey * 7) || 'y' END"""
_PATH = """CASE p_partkey % 4 WHEN 0 THEN '/c/train/' || p_type || '/x.wav' WHEN 1 THEN '/c/a' || (p_partkey * 3) || 'b/S' || p_size || '/x.wav' WHEN 2 THEN '/c/dev-clean/' || p_brand || '/' || p_partkey || '.wav' ELSE '/c/y.wav' END"""
_SPEAKER = r"""coalesce(nullif(regexp_extract({x}, '\bS[0-9]{{3,6}}\b'), ''), nullif(regexp_extract({x}, '\bid[0-9]{{3,6}}\b'), ''), nullif(regexp_extract({x}, '\bspk(?:er|r)?[_-]?[0-9]{{1,6}}\b'), ''),
  nullif(regexp_extract({x}, '\bspeaker[_-]?[0-9]{{1,6}}\b'), ''), nullif(regexp_extract({x}, '\b[0-9]{{3,6}}[_-][0-9]{{3,6}}\b'), ''), nullif(regexp_extract({x}, '(?:^|[^0-9])([0-9]{{3,6}})(?:[^0-9]|$)', 1), ''))"""
_BELOW = "list_filter(list_transform(range(1, len(parts)), lambda k: CASE WHEN parts[k] IN ({names}) THEN parts[k + 1] END), lambda v: v IS NOT NULL)[1]"


@plan(f"""WITH a AS (SELECT p_partkey, {_AUDIO} AS audio_id, {_PATH} AS path FROM part), b AS (SELECT *, list_filter(string_split(path, '/'), lambda v: v NOT IN ('', '.')) AS parts FROM a)
  SELECT p_partkey, coalesce({_SPEAKER.format(x='audio_id')}, list_filter(list_transform(list_reverse(parts), lambda v: {_SPEAKER.format(x='v')}), lambda v: v IS NOT NULL)[1],
    {_BELOW.format(names="'train', 'dev', 'test'")}, {_BELOW.format(names="'dev-clean', 'dev-other', 'test-clean', 'test-other', 'train-clean-100', 'train-clean-360', 'train-other-500'")}, 'UNKNOWN') AS speaker,
    CASE WHEN trim(audio_id) <> '' THEN trim(audio_id) ELSE regexp_replace(parts[len(parts)], '[.][^.]*$', '') END AS file_id FROM b""")
def parse_spk_id(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_AUDIO} AS audio_id", f"{_PATH} AS path")
    return rows.select("p_partkey", ids.parse_speaker(F.col("audio_id"), F.col("path")).alias("speaker"), ids.file_id(F.col("audio_id"), F.col("path")).alias("file_id"))


@plan(f"WITH {SEGMENTS} SELECT seg_id, sha256('/d/' || audio_id || '.tar::a.wav') AS wav_uuid, sha256(sha256('/d/' || audio_id || '.tar::a.wav') || '::' || printf('%.4f', round(start_sec / 7, 4))) AS seg_uuid FROM segments")
def segment_uuid(spark, sf_dir):
    wav = ids.member_uuid(F.concat(F.lit("/d/"), "audio_id", F.lit(".tar")), F.lit("a.wav"))
    return proxies.segments(spark, sf_dir).select("seg_id", wav.alias("wav_uuid"), ids.segment_uuid(wav, F.col("start_sec") / 7).alias("seg_uuid"))


@plan("SELECT event_id, round(value, 3) AS r3, round(value, 4) AS r4, CAST(round(value * 1000) AS BIGINT) AS ms, CAST(trunc(value * 16000) AS BIGINT) AS frames FROM events")
def round_times(spark, sf_dir):
    v = F.col("value")
    return table(spark, sf_dir, "events").select("event_id", F.round(v, 3).alias("r3"), F.round(v, 4).alias("r4"), numbers.millis(v).alias("ms"), numbers.samples(v).alias("frames"))


_RAW = """CASE event_id % 12 WHEN 0 THEN '' WHEN 1 THEN 'nan' WHEN 2 THEN event_type WHEN 3 THEN user_id || 'd' WHEN 4 THEN user_id || '_' || event_id WHEN 5 THEN ' ' || event_id || '.5 '
  WHEN 6 THEN '-' || user_id || 'e' || (event_id % 9) WHEN 7 THEN '+.' || event_id WHEN 8 THEN user_id || '.' WHEN 9 THEN user_id || '__' || event_id WHEN 10 THEN '1e-' || (event_id % 300) END"""
_FLOAT = r"""CASE WHEN regexp_full_match(trim(raw), '[+-]?([0-9]+(_[0-9]+)*[.]?([0-9]+(_[0-9]+)*)?|[.][0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+)?') THEN TRY_CAST(replace(trim(raw), '_', '') AS DOUBLE) END"""


@plan(f"WITH r AS (SELECT event_id, {_RAW} AS raw FROM events) SELECT event_id, {_FLOAT} AS value, coalesce({_FLOAT}, 0) AS filled FROM r")
def parse_float(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("event_id", f"{_RAW} AS raw")
    return rows.select("event_id", text.parse_float(F.col("raw")).alias("value"), text.parse_float(F.col("raw"), 0.0).alias("filled"))


@plan(f"SELECT conv_id, turn, regexp_replace(text, '^[{SPACES}]+|[{SPACES}]+$', '', 'g') AS text, role AS tag FROM conversations")
def strip_special_tokens(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumns({"marked": F.concat(F.lit("<|en|><|transcribe|> "), "text", F.lit(" <|endoftext|>")), "tag": F.concat(F.lit("<|"), "role", F.lit("|>"))})
    return rows.select("conv_id", "turn", text.strip_special_tokens(F.col("marked")).alias("text"), text.tag_name(F.col("tag")).alias("tag"))


@plan(f"WITH {SEGMENTS} SELECT audio_id, greatest(50, least(448, CAST(trunc(max(duration_sec) * 25 + 50) AS INT))) AS budget FROM segments GROUP BY audio_id")
def decode_budget(spark, sf_dir):
    return proxies.segments(spark, sf_dir).groupBy("audio_id").agg(numbers.decode_budget(F.max("duration_sec")).alias("budget"))


_MESSAGE = """CASE WHEN event_id % 11 = 0 THEN NULL ELSE CASE user_id % 4 WHEN 0 THEN 'CUDA' WHEN 1 THEN 'Torch.Cuda' WHEN 2 THEN 'host' ELSE 'cud' END || ' ' || event_type || ' '
  || CASE event_id % 5 WHEN 0 THEN 'Out Of Memory' WHEN 1 THEN 'no MEMORY left' WHEN 2 THEN 'out of  memory' WHEN 3 THEN 'bad header' ELSE '' END END"""


@plan(f"""WITH m AS (SELECT event_id, {_MESSAGE} AS m FROM events) SELECT event_id, CASE WHEN m IS NULL THEN NULL WHEN m ILIKE '%out of memory%' OR m ILIKE '%cuda%' AND m ILIKE '%memory%' THEN 'asr_failed:oom' ELSE 'asr_failed:asr_error' END AS error FROM m""")
def error_class(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr("event_id", f"{_MESSAGE} AS m").select("event_id", text.error_class(F.col("m")).alias("error"))

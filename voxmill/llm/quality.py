"""Quality classifier: Bradley-Terry scores learned from preference pairs, cut at a score quantile."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import bit_set, give_back, maybe_in, release, store, task
from .words import Words, find_words, stems, text_chunks

SHARD = 12_000
MIN_Z = 5.0
MIN_SEEN = 6
FOLDS = 4
STEM_BYTES = 6
PAIRS = 2048
STEPS = 400
L2 = 1e-3
_STYLE = 9
_BITS = 20


class Model(NamedTuple):
    """``word`` are the sorted hashes of the chosen words and stems; weights are of these, then of the style features.

    Documents that score below ``limit`` are rejected; it is the quantile ``level`` of
    the scores of held-out labelled documents, None without documents of both kinds.
    """

    word: np.ndarray
    weight: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    limit: float | None = None
    level: float = 0.0


def short(value: np.ndarray) -> np.ndarray:
    """The upper half of word hashes, by which the model names its words."""
    return (value >> np.uint64(32)).astype(np.uint32)


def _lower(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return data + upper.astype(np.uint8) * np.uint8(32)


def _sums(flag: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)


def style(data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """float64 (documents, 9): shares of characters and words that say how a text is written; zeros if it has no words."""
    n_bytes = np.diff(offsets).astype(np.float64)
    n_words = np.diff(words.first).astype(np.float64)
    upper = _sums((data >= 65) & (data <= 90), offsets)
    lower = _sums((data >= 97) & (data <= 122), offsets)
    digits = _sums((data >= 48) & (data <= 57), offsets)
    marks = np.zeros(256, bool)
    marks[[*b"!#$%&*|<>{}[]~^_=+\\/@"]] = True
    mark = _sums(marks[data], offsets)
    stops = _sums(np.isin(data, np.frombuffer(b".,;:?", np.uint8)), offsets)
    lines = _sums(data == 10, offsets)
    again = np.zeros(len(words.hash), bool)
    if len(again) > 1:
        again[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    repeated = _sums(again, words.first)
    length = _sums(words.end - words.start, words.first)
    w, b = np.maximum(n_words, 1), np.maximum(n_bytes, 1)
    out = np.stack(
        [
            np.sqrt(upper / np.maximum(upper + lower, 1)), np.sqrt(digits / b), np.sqrt(mark / w), np.sqrt(stops / w), np.sqrt(lines / w),
            np.sqrt(repeated / w), np.minimum(length / w, 40) / 10, np.sqrt(mark / b), np.log1p(n_words) / 10,
        ],
        axis=1,
    )
    out[n_words == 0] = 0
    return out


def terms(data: np.ndarray, words: Words) -> np.ndarray:
    """uint32 (2, words): a hash of each word and one of its stem."""
    return np.stack([short(words.hash), short(stems(data, words, STEM_BYTES))])


def _read(column: pa.Array) -> Iterator[tuple[int, int, Words, np.ndarray, np.ndarray]]:
    for a, b, data, offsets in text_chunks(column):
        low = _lower(data)
        words = find_words(low, offsets)
        yield a, b, words, terms(low, words), style(data, offsets, words)


_SUMS = ("n", "s", "q")


@task()
def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, part, n, s, q) of rows (part, text): documents of a part that have the term, sums of its root shares and of their squares."""
    for batch in batches:
        part = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, _, words, term, _ in _read(batch.column(1)):
            for of in term:
                # one row for each document and term, then one for each part and term
                key = words.doc << 32 | of.astype(np.int64)
                cell, count = np.unique(key, return_counts=True)
                doc = cell >> 32
                share = np.sqrt(count / np.diff(words.first)[doc])
                key, at = np.unique(part[a + doc] << 32 | (cell & 0xFFFFFFFF), return_inverse=True)
                cols = [np.bincount(at, weights=w, minlength=len(key)) for w in (None, share, share * share)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key & 0xFFFFFFFF), pa.array((key >> 32).astype(np.int32)), pa.array(cols[0].astype(np.int64)), pa.array(cols[1]), pa.array(cols[2])],
                    names=["term", "part", *_SUMS],
                )


def significant_terms(sample: DataFrame, n_bad: int, n_good: int, min_z: float) -> np.ndarray:
    """Sorted hashes of the terms whose root share of a text, or mere presence, differs significantly between bad and good documents.

    ``sample`` has (part, text), part 0 for the ``n_bad`` bad ones and 1 for the
    ``n_good`` good ones. Executors count; the driver gets significant terms only.
    """
    if n_bad < 2 or n_good < 2:
        return np.zeros(0, np.uint32)
    rows = sample.mapInArrow(_term_rows, "term bigint, part int, n bigint, s double, q double")
    sums = rows.groupBy("term").agg(*(F.sum(F.when(F.col("part") == p, F.col(c)).otherwise(F.lit(0))).alias(f"{c}{p}") for p in (0, 1) for c in _SUMS))
    tests = []
    for s, q, floor in (("s", "q", 1e-7), ("n", "n", 1e-3)):
        m = [f"({s}{p} / {n}D)" for p, n in ((0, n_bad), (1, n_good))]
        v = [f"({q}{p} / {n}D - {x} * {x} + {floor!r}D) / {n}D" for p, n, x in ((0, n_bad, m[0]), (1, n_good, m[1]))]
        tests.append(f"abs({m[0]} - {m[1]}) / sqrt({v[0]} + {v[1]})")
    found = sums.where(f"n0 + n1 >= {MIN_SEEN} AND greatest({', '.join(tests)}) >= {min_z}").select("term").toArrow()
    return np.sort(found.column("term").to_numpy().astype(np.uint32))


@task()
def _feature_rows(batches: Iterator[pa.RecordBatch], word: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(part, place, share, style) of rows (part, text): the places in ``word`` of a document's terms, and their root shares."""
    for batch in batches:
        for a, b, words, term, features in _read(batch.column(1)):
            at, count = places(word, words, term)
            doc = at // max(1, len(word))
            share = np.sqrt(count / np.diff(words.first)[doc]).astype(np.float32)
            cuts = np.searchsorted(doc, np.arange(b - a + 1))
            own = [((at[x:y] % len(word)).astype(np.int32).tobytes() if y > x else b"", share[x:y].tobytes()) for x, y in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), *(pa.array(x, pa.binary()) for x in ([o[0] for o in own], [o[1] for o in own], [f.tobytes() for f in features]))], names=["part", "place", "share", "style"]
            )


def places(word: np.ndarray, words: Words, term: np.ndarray, member: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document * number of chosen terms + place of the term, how often) of the chosen terms of each document."""
    if not len(word):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cells = []
    for value in term:
        at = np.flatnonzero(member[value >> np.uint32(32 - _BITS)]) if member is not None else np.arange(len(value))
        k = np.minimum(np.searchsorted(word, value[at]), len(word) - 1)
        hit = word[k] == value[at]
        cells.append(words.doc[at[hit]] * len(word) + k[hit])
    return np.unique(np.concatenate(cells), return_counts=True)


def fit_pairs(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, steps: int = STEPS, l2: float = L2, seed: int = 7) -> np.ndarray:
    """Weights w by which P(a preferred to b) = 1 / (1 + exp(-w.(x_a - x_b))) best explains pairs of a good and a bad row.

    Each of ``steps`` steps draws ``pairs`` new pairs.
    """
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    w = np.zeros(x.shape[1])
    if not len(up) or not len(down):
        return w
    rng = np.random.default_rng(seed)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        some = x[rng.choice(up, pairs)] - x[rng.choice(down, pairs)]
        p = 1 / (1 + np.exp(np.clip(some @ w.astype(np.float32), -30, 30)))
        g = -(p @ some) / pairs + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def fit_sparse(first: np.ndarray, place: np.ndarray, share: np.ndarray, own: np.ndarray, good: np.ndarray, n_words: int, pairs: int = PAIRS, steps: int = STEPS, l2: float = L2, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(weights of the features as they are, means) as by ``fit_pairs`` of features with mean 0 and deviation 1.

    Row k has the shares from ``first[k]`` to ``first[k + 1]`` at their places, then the style features ``own[k]``.
    """
    n, row = len(good), np.repeat(np.arange(len(good)), np.diff(first))
    mean = np.concatenate([np.bincount(place, share, n_words) / max(1, n), own.mean(axis=0)])
    square = np.concatenate([np.bincount(place, share.astype(np.float64) ** 2, n_words) / max(1, n), (own**2).mean(axis=0)])
    scale = np.sqrt(np.maximum(square - mean * mean, 0))
    scale = np.where(scale > 1e-9, scale, 1.0)
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    w = np.zeros(n_words + own.shape[1])
    if not len(up) or not len(down):
        return w, mean
    rng = np.random.default_rng(seed)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        of = w / scale
        score = np.bincount(row, share * of[place], n) + own @ of[n_words:]
        i, j = rng.choice(up, pairs), rng.choice(down, pairs)
        p = 1 / (1 + np.exp(np.clip(score[i] - score[j], -30, 30)))
        part = np.bincount(i, p, n) - np.bincount(j, p, n)
        g = -np.concatenate([np.bincount(place, share * part[row], n_words), part @ own]) / scale / pairs + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w / scale, mean


def _fit_shard(rows: pa.Table, n_words: int) -> pa.Table:
    """One row (n, weight, mean) of a shard of rows (shard, doc_id, good, place, share, style), none if it lacks a kind."""
    rows = rows.sort_by("doc_id").combine_chunks()
    place, share, own = (x.to_pylist() for x in (rows["place"], rows["share"], rows["style"]))
    first = np.concatenate([[0], np.cumsum([len(x) // 4 for x in place])]).astype(np.int64)
    style_of = np.frombuffer(b"".join(own), np.float64).reshape(-1, _STYLE)
    good = rows["good"].to_numpy().astype(bool)
    weight, mean = fit_sparse(first, np.frombuffer(b"".join(place), np.int32), np.frombuffer(b"".join(share), np.float32), style_of, good, n_words)
    out = pa.table({"n": pa.array([len(good)], pa.int64()), "weight": pa.array([weight.tobytes()]), "mean": pa.array([mean.tobytes()])})
    return out if good.any() and not good.all() else out.slice(0, 0)


def best_level(score: np.ndarray, good: np.ndarray) -> float:
    """The share of the lowest scores to reject with the fewest wrong decisions, good ones rejected or others kept; of several the least.

    Equal scores are rejected together.
    """
    order = np.argsort(score, kind="stable")
    s, g = score[order], good[order]
    wrong = np.concatenate([[0], np.cumsum(np.where(g, 1, -1))])
    able = np.concatenate([[True], s[1:] != s[:-1], [True]]) if len(s) else np.ones(1, bool)
    at = np.flatnonzero(able)
    return float(at[wrong[at].argmin()] / max(1, len(s)))


def quantile_limit(score: np.ndarray, level: float) -> float:
    """The score below which the share ``level`` of the scores lies: midway between the two beside it."""
    s = np.sort(score)
    k = min(int(round(level * len(s))), len(s))
    return float(s[0]) if k == 0 else float(np.nextafter(s[-1], np.inf)) if k == len(s) else float((s[k - 1] + s[k]) / 2)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        n = len(model.word)
        self.of_word = model.weight[:n] / model.scale[:n]
        self.of_style = model.weight[n:] / model.scale[n:]
        self.base = -float(model.weight @ (model.mean / model.scale))
        self.member = np.zeros(1 << _BITS, bool)
        self.member[model.word >> np.uint32(32 - _BITS)] = True

    def __call__(self, words: Words, term: np.ndarray, features: np.ndarray) -> np.ndarray:
        score = features @ self.of_style + self.base
        if len(self.of_word):
            cell, count = places(self.model.word, words, term, self.member)
            doc = cell // len(self.of_word)
            share = np.sqrt(count / np.diff(words.first)[doc])
            score += np.bincount(doc, share * self.of_word[cell % len(self.of_word)], len(score))
        return np.round(score, 9)


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, part, text): all labelled documents, one text an id.

    ``part`` is 0 for bad and 1 for good ones, 2 and 3 for those that are held out, one in ``FOLDS`` by a hash of the id.
    """
    chosen, _ = store(verdicts(labels))
    sent = bit_set(chosen.select("__id"))

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(maybe_in(sent.value, batch.column(0).to_numpy(zero_copy_only=False))))

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")).where("doc_id IS NOT NULL")
    one = rows.mapInArrow(maybe, rows.schema).join(chosen, F.col("doc_id") == F.col("__id")).groupBy("doc_id", "good").agg(F.min("text").alias("text"))
    part = 2 * (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)) == 0).cast("int") + F.col("good").cast("int")
    return one.select("doc_id", part.cast("int").alias("part"), "text")


def verdicts(labels: DataFrame) -> DataFrame:
    """(__id, good): good if every label of an id says quality 1 and toxic 0; labels with a null are left out."""
    return (
        labels.select(F.col("doc_id").cast("bigint").alias("__id"), (F.expr("quality = 1 AND toxic = 0")).alias("g"))
        .where("__id IS NOT NULL AND g IS NOT NULL").groupBy("__id").agg(F.min("g").alias("good"))
    )


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shard: int = SHARD, min_z: float = MIN_Z) -> Model:
    """The model of all labelled documents; without a good and a bad one all weights are zero.

    It is fitted on all but the held-out ones, by executors on shards of about ``shard``
    documents whose weights are averaged; on all held-out ones the level of its threshold
    is chosen and the quantile taken, or on the fitted ones if a kind is not among them.
    """
    sample, _ = store(labelled(docs, labels, id_col, text_col))
    release(docs.sparkSession)
    known = {r.part: r["count"] for r in sample.groupBy("part").count().collect()}
    word = significant_terms(sample.where("part < 2").select("part", "text"), known.get(0, 0), known.get(1, 0), min_z)
    size = len(word) + _STYLE
    none = Model(word, np.zeros(size), np.zeros(size), np.ones(size))
    if not known.get(0) or not known.get(1):
        return none
    sent, n_words = docs.sparkSession.sparkContext.broadcast(word), len(word)
    shards = -(-(known[0] + known[1]) // shard)
    place = F.struct(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(shards)).alias("shard"), "doc_id", (F.col("part") == 1).alias("good"))
    rows = sample.where("part < 2").select(place.alias("part"), "text")
    rows = rows.mapInArrow(lambda it: _feature_rows(it, sent.value), "part struct<shard:bigint,doc_id:bigint,good:boolean>, place binary, share binary, style binary")

    def fit(table: pa.Table) -> pa.Table:
        out = _fit_shard(table, n_words)
        give_back()
        return out

    fitted = rows.select("part.*", "place", "share", "style").groupBy("shard").applyInArrow(fit, "n bigint, weight binary, mean binary").toArrow().sort_by([("n", "ascending"), ("weight", "ascending")])
    if not fitted.num_rows:
        return none
    n = fitted["n"].to_numpy()
    weight, mean = (np.average([np.frombuffer(x, np.float64) for x in fitted[c].to_pylist()], axis=0, weights=n) for c in ("weight", "mean"))
    model = none._replace(weight=weight, mean=mean)
    use = sample.where("part >= 2" if known.get(2) and known.get(3) else "part < 2")
    of = docs.sparkSession.sparkContext.broadcast(model)
    got = use.select("part", "text").mapInArrow(lambda it: _part_scores(it, Scorer(of.value)), "part int, score double").toArrow()
    score, good = got.column("score").to_numpy(), got.column("part").to_numpy() % 2 == 1
    level = best_level(score, good)
    return model._replace(limit=quantile_limit(score, level), level=level)


@task()
def _part_scores(batches: Iterator[pa.RecordBatch], scorer: Scorer) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(batch.column(1), scorer))], names=["part", "score"])


def _scores(column: pa.Array, scorer: Scorer) -> np.ndarray:
    score = np.zeros(len(column))
    for a, b, words, term, features in _read(column):
        score[a:b] = scorer(words, term, features)
    return score


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row, rows with a null id too."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").cast("string"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @task()
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(batch.column(1), scorer))], names=["doc_id", "score"])

    return rows.mapInArrow(score, "doc_id bigint, score double")


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, score, threshold, kept) of every row of ``docs``.

    A Bradley-Terry model is fitted by logistic loss on the feature differences
    of pairs of a good document (quality 1, not toxic) and a bad one; features
    are root shares of all words and word stems that differ significantly, over all
    labelled documents, and style shares. The threshold is a quantile
    of the scores of all held-out documents, at the level with the fewest
    wrong decisions on them (of several the lowest). Documents below it are rejected.

    Null and empty texts have no features and get the score of a text without
    words; a null id is scored and never counts as labelled; repeated rows are
    scored each, and count once as labelled (with the least of their texts); equal scores get
    equal decisions. Without labels of both kinds all documents are kept. An
    empty table gives no row; other columns are ignored whatever their names.
    """
    model = train(docs, labels, id_col, text_col, **options)
    limit = F.lit(model.limit).cast("double")
    return score_documents(docs, model, id_col, text_col).select("doc_id", "score", limit.alias("threshold"), (F.lit(model.limit is None) | F.coalesce(F.col("score") >= limit, F.lit(False))).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with all of their columns; null and repeated rows are judged as there."""
    model = train(docs, labels, id_col, text_col, **options)
    if model.limit is None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    @task()
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(place).cast(pa.large_string()), scorer) >= sent.value.limit))

    return docs.mapInArrow(rows, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))

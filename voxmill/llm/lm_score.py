"""LM scoring: masked pseudo-likelihood under a bidirectional window network trained in NumPy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import as_documents, cut, release
from .words import find_words, text_chunks

VOCABULARY = 65_536
CLASSES = 2048
OWN_CLASSES = 1984
MEMBERS = 64
HIDDEN = 24
STRIDE = 2
ROUNDS = 2
_BATCH = 4096
_RATE = 0.1
_COUNT_ROWS = 1 << 18
_SLICE = 4096
_NEVER = -30.0
_SLOT_BITS = 18


class Lexicon(NamedTuple):
    """The most frequent words by sorted hash, with class and log P(word | class); ``mass`` has each class's count of all words.

    ``slot`` tells where the words begin whose hash starts with the bits of its index. Other words' counts stay in the table of counts and are joined to the documents.
    """

    word: np.ndarray
    slot: np.ndarray
    cls: np.ndarray
    logp: np.ndarray
    mass: np.ndarray
    classes: int
    own: int


def class_of(word: np.ndarray, classes: int, own: int) -> np.ndarray:
    """The hash class of words that have no class of their own; class 0 is the text's edge."""
    return 1 + own + np.mod(word.view(np.int64), classes - own - 1)


def lexicon(word: np.ndarray, count: np.ndarray, hashed: np.ndarray, classes: int, own: int) -> Lexicon:
    """Of the most frequent words, their counts, and the count of all words in each hash class, before any has a class of its own.

    The ``own`` most frequent words are classes of their own.
    """
    rank = np.lexsort((word, -count))
    cls = class_of(word, classes, own)
    mass = np.zeros(classes)
    mass[1 + own :] = hashed
    np.subtract.at(mass, cls[rank[:own]], count[rank[:own]])
    cls[rank[:own]] = 1 + np.arange(min(own, len(word)))
    mass[cls[rank[:own]]] = count[rank[:own]]
    order = np.argsort(word)
    word, count, cls = word[order], count[order].astype(np.float64), cls[order]
    slot = np.searchsorted(word >> np.uint64(64 - _SLOT_BITS), np.arange((1 << _SLOT_BITS) + 1, dtype=np.uint64)).astype(np.int32)
    return Lexicon(word, slot, cls, np.log(count / mass[cls]), mass, classes, own)


def classify(lex: Lexicon, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, log P(word | class), whether it is in the lexicon) of each word; the log-probability of others is 0 here."""
    cls = class_of(value, lex.classes, lex.own)
    if not len(lex.word):
        return cls, np.zeros(len(value)), np.zeros(len(value), bool)
    cell = (value >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
    at = np.minimum(lex.slot.take(cell), len(lex.word) - 1)
    hit = lex.word.take(at) == value
    left = np.flatnonzero(~hit)
    while len(left := left[at[left] + 1 < lex.slot[cell[left] + 1]]):
        at[left] += 1
        same = lex.word[at[left]] == value[left]
        hit[left[same]] = True
        left = left[~same]
    return np.where(hit, lex.cls.take(at), cls), np.where(hit, lex.logp.take(at), 0.0), hit


class Network(NamedTuple):
    """A hidden layer for each side of two context classes; both layers predict a word's group, then its class within the group.

    Class c is member c % members of group c // members.
    """

    embed: np.ndarray  # (2 sides, 2 places, classes, hidden): what a class at a place adds to the side's hidden layer
    shift: np.ndarray  # (2 * hidden,)
    outer: np.ndarray  # (2 * hidden, groups)
    outer_bias: np.ndarray  # (groups,)
    inner: np.ndarray  # (groups, 2 * hidden, members)
    inner_bias: np.ndarray  # (groups, members)


def fresh_network(classes: int, members: int = MEMBERS, hidden: int = HIDDEN, seed: int = 3) -> Network:
    """A network with small random weights; what is no class that a word can have starts as all but impossible."""
    r = np.random.default_rng(seed)
    draw = lambda *s, scale: (r.standard_normal(s) * scale).astype(np.float32)
    groups = -(-classes // members)
    bias = np.zeros((groups, members), np.float32)
    bias.ravel()[[0, *range(classes, groups * members)]] = _NEVER
    return Network(
        draw(2, 2, classes, hidden, scale=0.3), np.zeros(2 * hidden, np.float32), draw(2 * hidden, groups, scale=0.1), np.zeros(groups, np.float32),
        draw(groups, 2 * hidden, members, scale=0.1), bias,
    )


def hidden_layer(net: Network, context: np.ndarray) -> np.ndarray:
    """(n, 2 * hidden) of contexts (n, 4): left near, left far, right near, right far."""
    e = net.embed
    wide = e.shape[3]
    x = np.empty((len(context), 2 * wide), e.dtype)
    for k in (0, 1):
        np.add(e[k, 0].take(context[:, 2 * k], axis=0), e[k, 1].take(context[:, 2 * k + 1], axis=0), out=x[:, k * wide : (k + 1) * wide])
    x += net.shift
    return np.tanh(x, out=x)


def _by_group(net: Network, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the targets by group, bounds of the groups in it, group of each target)."""
    group = target // net.inner.shape[2]
    order = np.argsort(group.astype(np.uint16), kind="stable")
    return order, np.searchsorted(group[order], np.arange(net.inner.shape[0] + 1)), group


def _exp_logits(logits: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log-probability of each target, sums of what is then in place of the logits, their exponentials); logits count as at least -30 and at most 30."""
    np.clip(logits, _NEVER, -_NEVER, out=logits)
    picked = logits[np.arange(len(target)), target].astype(np.float64)
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    return picked - np.log(total), total


def _softmax(logits: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log-probability of each target, probabilities in place of the logits)."""
    logp, total = _exp_logits(logits, target)
    logits /= total[:, None]
    return logp, logits


def _inner_logits(net: Network, h: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """(n, members) of rows that are in the order of their groups."""
    out = np.empty((len(h), net.inner.shape[2]), h.dtype)
    for g in np.flatnonzero(np.diff(cuts)):
        x = slice(cuts[g], cuts[g + 1])
        np.matmul(h[x], net.inner[g], out=out[x])
        out[x] += net.inner_bias[g]
    return out


def log_probabilities(net: Network, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log P(target class | context classes)."""
    order, cuts, group = _by_group(net, target)
    h = hidden_layer(net, context[order])
    logp = _exp_logits(h @ net.outer + net.outer_bias, group[order])[0] + _exp_logits(_inner_logits(net, h, cuts), target[order] % net.inner.shape[2])[0]
    out = np.empty(len(target))
    out[order] = logp
    return out


def loss_and_gradient(net: Network, context: np.ndarray, target: np.ndarray) -> tuple[float, Network]:
    """Mean negative log-probability of the middle classes and its gradient.

    The gradient of ``embed`` is a list, by side and place, of (classes that occur, their gradients).
    """
    n = len(target)
    order, cuts, group = _by_group(net, target)
    context, target, group = context.take(order, axis=0), target[order], group[order]
    h = hidden_layer(net, context)
    logp, p = _softmax(h @ net.outer + net.outer_bias, group)
    p[np.arange(n), group] -= 1
    p /= n
    outer, outer_bias = h.T @ p, p.sum(axis=0)
    back = p @ net.outer.T
    member = target % net.inner.shape[2]
    more, q = _softmax(_inner_logits(net, h, cuts), member)
    q[np.arange(n), member] -= 1
    q /= n
    inner, inner_bias = np.zeros_like(net.inner), np.zeros_like(net.inner_bias)
    for g in np.flatnonzero(np.diff(cuts)):
        x = slice(cuts[g], cuts[g + 1])
        np.matmul(h[x].T, q[x], out=inner[g])
        inner_bias[g] = q[x].sum(axis=0)
        back[x] += q[x] @ net.inner[g].T
    h *= h
    back -= back * h
    sides = [np.ascontiguousarray(x) for x in np.split(back, 2, axis=1)]
    embed = []
    for k, column in enumerate(np.ascontiguousarray(context.T)):
        order = np.argsort(column.astype(np.uint16), kind="stable")
        cls = column[order]
        first = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]]))
        embed.append((cls[first], np.add.reduceat(sides[k // 2].take(order, axis=0), first, axis=0)))
    return -float((logp + more).mean()), Network(embed, back.sum(axis=0), outer, outer_bias, inner, inner_bias)


class Trainer:
    """Mini-batches of one partition, with a step for each weight that shrinks with its past gradients."""

    def __init__(self, net: Network, rate: float = _RATE):
        self.net = Network(*(x.copy() for x in net))
        self.past = Network(*(np.full_like(x, 1e-6) for x in net))
        self.rate, self.seen = rate, 0

    def step(self, context: np.ndarray, target: np.ndarray) -> float:
        loss, g = loss_and_gradient(self.net, context, target)
        self.seen += len(target)
        for k, (cls, d) in enumerate(g.embed):
            past = self.past.embed[k // 2, k % 2]
            past[cls] += d * d
            self.net.embed[k // 2, k % 2][cls] -= self.rate * d / np.sqrt(past[cls])
        for x, past, d in zip(self.net[1:], self.past[1:], g[1:]):
            past += d * d
            x -= self.rate * d / np.sqrt(past)
        return loss


def contexts(cls: np.ndarray, first: np.ndarray, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """(n, 4) context classes of the words at the given positions; 0 beyond the text's edge."""
    lo, hi = first[doc], first[doc + 1]
    out = np.zeros((len(at), 4), np.int64)
    for k, d in enumerate((-1, -2, 1, 2)):
        p = at + d
        out[:, k] = np.where((p >= lo) & (p < hi), cls[np.clip(p, 0, len(cls) - 1)], 0)
    return out


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of the words of a partition, counted in parts of bounded size."""
    held: list[np.ndarray] = []
    size = 0

    def flush() -> pa.RecordBatch:
        word, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column(1)):
            held.append(find_words(data, offsets).hash)
            size += len(held[-1])
            if size > 16 * _COUNT_ROWS:
                yield flush()
                held, size = [], 0
    if size:
        yield flush()


def _mass_rows(batches: Iterator[pa.RecordBatch], classes: int, own: int) -> Iterator[pa.RecordBatch]:
    """(cls, n) sums of the counts of a partition's words by hash class."""
    total = np.zeros(classes, np.int64)
    for batch in batches:
        np.add.at(total, class_of(batch.column(0).to_numpy().view(np.uint64), classes, own), batch.column(1).to_numpy())
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes), pa.int32()), pa.array(total)], names=["cls", "n"])


def _trained_rows(batches: Iterator[pa.RecordBatch], lex: Lexicon, net: Network, stride: int, shift: int, rate: float) -> Iterator[pa.RecordBatch]:
    """(slice, seen, weights): the partition's network in slices of equal size."""
    trainer = Trainer(net, rate)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    rng = np.random.default_rng(shift)

    def learn() -> None:
        context, target = (np.concatenate(x) for x in zip(*held))
        order = rng.permutation(len(target))
        for k in range(0, len(order), _BATCH):
            trainer.step(context[order[k : k + _BATCH]], target[order[k : k + _BATCH]])

    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column(1)):
            words = find_words(data, offsets)
            cls = classify(lex, words.hash)[0]
            at = np.arange(shift % stride, len(cls), stride)
            held.append((contexts(cls, words.first, at, words.doc[at]), cls[at]))
            size += len(at)
            if size >= 32 * _BATCH:
                learn()
                held, size = [], 0
    if size:
        learn()
    if trainer.seen:
        flat = np.concatenate([x.ravel() for x in trainer.net]).astype("<f4")
        parts = [flat[k : k + _SLICE].tobytes() for k in range(0, len(flat), _SLICE)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([trainer.seen] * len(parts)), pa.array(parts, pa.binary())], names=["slice", "seen", "weights"])


def _summed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slice, seen, weights): of each slice the sum over all partitions' networks, weighted by the words they have seen."""
    total: dict[int, list] = {}
    for batch in batches:
        for k, seen, raw in zip(*(c.to_pylist() for c in batch.columns)):
            x = np.frombuffer(raw, "<f4") * np.float64(seen)
            if k in total:
                total[k][0] += seen
                total[k][1] += x
            else:
                total[k] = [seen, x]
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([n for n, _ in total.values()]), pa.array([x.tobytes() for _, x in total.values()], pa.binary())], names=["slice", "seen", "weights"]
        )


def _score_rows(batches: Iterator[pa.RecordBatch], lex: Lexicon, net: Network) -> Iterator[pa.RecordBatch]:
    """(doc_id, key, words, score): the score lacks log P(word | class) of the words outside the lexicon."""
    for batch in batches:
        score = np.zeros(batch.num_rows)
        count = np.zeros(batch.num_rows, np.int64)
        for a, b, data, offsets in text_chunks(batch.column(1)):
            words = find_words(data, offsets)
            count[a:b] = np.diff(words.first)
            if not len(words.hash):
                continue
            cls, logp, _ = classify(lex, words.hash)
            for k in range(0, len(cls), 2 * _BATCH):
                at = np.arange(k, min(k + 2 * _BATCH, len(cls)))
                logp[at] += log_probabilities(net, contexts(cls, words.first, at, words.doc[at]), cls[at])
            score[a:b] = np.bincount(words.doc, logp, b - a)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(count), pa.array(score)], names=["doc_id", "key", "words", "score"])


def _rare_rows(batches: Iterator[pa.RecordBatch], lex: Lexicon) -> Iterator[pa.RecordBatch]:
    """(word, key, times) of the words outside the lexicon, by text."""
    for batch in batches:
        keys = batch.column(2).to_numpy()
        for a, b, data, offsets in text_chunks(batch.column(1)):
            words = find_words(data, offsets)
            rare = np.flatnonzero(~classify(lex, words.hash)[2])
            word, doc = words.hash[rare].view(np.int64), words.doc[rare]
            order = np.lexsort((word, doc))
            word, doc = word[order], doc[order]
            first = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])])) if len(word) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(word[first]), pa.array(keys[a:b][doc[first]]), pa.array(np.diff(np.append(first, len(word))).astype(np.int32))], names=["word", "key", "times"])


def gather_lexicon(rows: DataFrame, vocabulary: int, classes: int, own: int) -> tuple[Lexicon, DataFrame]:
    """The lexicon of the ``vocabulary`` most frequent words, and the table (word, n) of the exact counts of all words over all documents."""
    counts = cut(rows.select("doc_id", "text").mapInArrow(_count_rows, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    sums = counts.mapInArrow(lambda it: _mass_rows(it, classes, own), "cls int, n bigint").groupBy("cls").agg(F.sum("n").alias("n"))
    mass = np.zeros(classes)
    for r in sums.collect():
        mass[r.cls] = r.n or 0
    top = counts.orderBy(F.desc("n"), "word").limit(vocabulary).toArrow()
    word = top.column("word").to_numpy().view(np.uint64) if len(top) else np.zeros(0, np.uint64)
    count = top.column("n").to_numpy() if len(top) else np.zeros(0, np.int64)
    return lexicon(word, count, mass[1 + own :], classes, own), counts


def train(rows: DataFrame, lex: Lexicon, *, stride: int = STRIDE, rounds: int = ROUNDS, members: int = MEMBERS) -> Network:
    """The network after ``rounds`` passes; in each, every partition trains on every ``stride``-th word of all its texts and the results are averaged.

    The passes begin one word apart, so that in ``stride`` of them each word is a
    target once. The averages are made by executors, a slice of the weights each;
    the driver gets one network a round. As ever with averaged training, how the
    table is partitioned has a part in the weights.
    """
    spark = rows.sparkSession
    net = fresh_network(lex.classes, members)
    sent = spark.sparkContext.broadcast(lex)
    for k in range(rounds):
        now = spark.sparkContext.broadcast(net)
        schema = "slice int, seen bigint, weights binary"
        parts = rows.select("doc_id", "text").mapInArrow(lambda it, now=now, k=k: _trained_rows(it, sent.value, now.value, stride, k, _RATE / (1 + k)), schema)
        sums = sorted(parts.repartition("slice").mapInArrow(_summed_rows, schema).collect(), key=lambda r: r.slice)
        if not sums:
            break
        flat, at, arrays = np.concatenate([np.frombuffer(r.weights, np.float64) / r.seen for r in sums]).astype(np.float32), 0, []
        for x in net:
            arrays.append(flat[at : at + x.size].reshape(x.shape))
            at += x.size
        net = Network(*arrays)
    return net


def rare_word_sums(rows: DataFrame, counts: DataFrame, lex: Lexicon, sent) -> DataFrame:
    """(key, rare): the sum of log P(word | class) over the words of a text that are outside the lexicon, of equal texts all together."""
    rare = rows.mapInArrow(lambda it: _rare_rows(it, sent.value), "word bigint, key bigint, times int")
    mass: Column = F.array(*(F.lit(float(np.log(max(m, 1)))) for m in lex.mass[1 + lex.own :]))
    logp = F.log(F.col("n")) - F.get(mass, F.pmod("word", F.lit(lex.classes - lex.own - 1)).cast("int"))
    return rare.join(counts, "word").groupBy("key").agg(F.sum(F.col("times") * logp).alias("rare"))


def pseudo_likelihoods(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: int = VOCABULARY, classes: int = CLASSES, own: int = OWN_CLASSES,
    members: int = MEMBERS, stride: int = STRIDE, rounds: int = ROUNDS,
) -> DataFrame:
    """(doc_id, words, per_word, log_likelihood): the summed log-probability of each word given the two words on either side, and its mean.

    P(word | both sides) = P(class | both sides) P(word | class). The classes'
    probabilities come from a window network with a hidden layer for each side,
    trained on all documents; the ``own`` most frequent words are classes of their
    own, others share classes by hash. The words' come from their exact counts over
    all documents: those of the ``vocabulary`` most frequent words are sent to all
    executors, all others are joined, so what is known of a word grows with the
    corpus. Every word of every text is predicted; the text's edge is a class of its own.

    Null, empty and word-less texts have 0 words and score 0; rows with a null
    id are left out; repeated rows are scored each and count each; words of equal
    count are ranked by hash; an empty table gives no row; other columns are
    ignored. Letter case is ignored.
    """
    rows = as_documents(docs, id_col, text_col).withColumn("key", F.xxhash64("doc_id", "text"))
    lex, counts = gather_lexicon(rows, vocabulary, classes, own)
    net = train(rows, lex, stride=stride, rounds=rounds, members=members)
    spark = docs.sparkSession
    sent_lex, sent_net = spark.sparkContext.broadcast(lex), spark.sparkContext.broadcast(net)
    scored = cut(rows.mapInArrow(lambda it: _score_rows(it, sent_lex.value, sent_net.value), "doc_id bigint, key bigint, words bigint, score double"))
    rare = rare_word_sums(rows, counts, lex, sent_lex)
    each = scored.groupBy("key").agg(F.count("*").alias("copies")).join(rare, "key").select("key", (F.col("rare") / F.col("copies")).alias("rare"))
    each = cut(each)
    release(spark)
    score = F.col("score") + F.coalesce("rare", F.lit(0.0))
    return scored.join(each, "key", "left").select(
        "doc_id", "words", F.round(score / F.greatest("words", F.lit(1)), 6).alias("per_word"), F.round(score, 4).alias("log_likelihood")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihoods(spark.read.parquet(f"{sf_dir}/documents.parquet"))

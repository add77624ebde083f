"""SentencePiece encoding and decoding: distinct segmentations sampled without replacement by perturbed A-star search."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import kept, task
from .token_counts import MODEL
from .unigram import SPACE, UNIT, Lattices, Vocabulary, decode, parse
from .words import mix64

SAMPLES = 2
THETA = 0.5
SEED = 20_240
_ROWS = 512
_CHARS = 500_000
_LEARNT_CHARS = 100_000
_KEPT_EDGES = 3_000_000


def uniform(key: np.ndarray, place: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1) that depend only on the key, the place and the salt."""
    h = mix64(key ^ mix64(place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)))
    return ((h >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


class Numbers(dict):
    """Numbers chunks as they are first asked for; those new since ``new`` was last emptied are listed there."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.new.append(chunk)
        self[chunk] = number = len(self)
        return number


class Tables:
    """Backward transition probabilities of the lattices of distinct chunks; new chunks are appended.

    The edges into node v are ``first[v]`` to ``first[v + 1]``; ``logp`` is the
    log-probability of each, given that a path passes through v, ``length`` its
    characters, ``piece`` its piece and ``ladder`` the cumulated share of v's edges up
    to it. The buffers grow by doubling; what is kept from one block of texts to the
    next has at most ``_KEPT_EDGES`` edges, which only affects speed.
    """

    _EDGE = (("logp", np.float64), ("ladder", np.float64), ("piece", np.int32), ("length", np.uint8))

    def __init__(self, lattices: Lattices, theta: float):
        self.lattices, self.theta = lattices, theta
        if lattices.room > 255:
            raise ValueError("pieces of at most 254 characters")
        for name, kind in self._EDGE:
            setattr(self, name, np.empty(1 << 16, kind))
        self.first = np.empty(1 << 16, np.int64)
        self.base, self.size = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64)
        self.clear()

    def clear(self) -> None:
        self.number = Numbers()
        self.edges = self.nodes = self.chunks = 0
        self.first[0] = 0

    def _put(self, name: str, at: int, values: np.ndarray) -> None:
        held = getattr(self, name)
        if at + len(values) > len(held):
            held = np.concatenate([held[:at], np.empty(max(at, len(values)) + len(values), held.dtype)])
            setattr(self, name, held)
        held[at : at + len(values)] = values

    def numbers(self, chunks: Iterator[str], count: int) -> np.ndarray:
        """The numbers of so many chunks; new ones are learnt."""
        try:
            out = np.fromiter(map(self.number.__getitem__, chunks), np.int64, count)
            new, self.number.new = self.number.new, []
            self.learn(new)
        except BaseException:
            self.clear()  # else there would be numbers without tables
            raise
        return out

    def learn(self, chunks: list[str]) -> None:
        """Adds chunks in the order of their numbers, a bounded number of characters at a time."""
        total = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
        at = 0
        while at < len(chunks):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _LEARNT_CHARS)))
            self._add(chunks[at:to])
            at = to

    def _add(self, chunks: list[str]) -> None:
        e = self.lattices.edges(chunks)
        n = int((e.size + 1).sum())
        alpha = np.zeros(n)
        score = e.score * (self.theta / UNIT)
        for a, b in zip(e.level, e.level[1:]):
            end = e.end[a:b]
            first = np.flatnonzero(np.concatenate([[True], end[1:] != end[:-1]]))
            term = alpha[e.start[a:b]] + score[a:b]
            most = np.maximum.reduceat(term, first)
            term -= np.repeat(most, np.diff(np.append(first, b - a)))
            alpha[end[first]] = most + np.log(np.add.reduceat(np.exp(term), first))
        # Edges with one end stand together: each such run moves to the place of its end.
        first = np.concatenate([[0], np.cumsum(np.bincount(e.end, minlength=n))])
        run = np.flatnonzero(np.concatenate([[True], e.end[1:] != e.end[:-1]]))
        order = np.empty(len(e.end), np.int64)
        order[np.arange(len(order)) + np.repeat(first[e.end[run]] - run, np.diff(np.append(run, len(order))))] = np.arange(len(order))
        start, end = e.start[order], e.end[order]
        logp = np.minimum(alpha[start] + score[order] - alpha[end], 0.0)
        logp[first[1:][np.diff(first) == 1] - 1] = 0.0
        whole = np.concatenate([[0.0], np.cumsum(np.exp(logp))])
        before = whole[first[end]]
        share = np.minimum((whole[1:] - before) / (whole[first[end + 1]] - before), 1.0)
        share[first[1:][np.diff(first) > 0] - 1] = 1.0
        for name, values in (("logp", logp), ("ladder", share), ("piece", e.piece[order]), ("length", end - start)):
            self._put(name, self.edges, values)
        self._put("first", self.nodes + 1, first[1:] + self.edges)
        self._put("base", self.chunks, e.base + self.nodes)
        self._put("size", self.chunks, e.size)
        self.edges += len(logp)
        self.nodes += n
        self.chunks += len(chunks)


class Path(NamedTuple):
    """The branching steps of one sampled path per text that are its own, by text and place.

    ``summed`` holds the running sum of the steps' log-probabilities, ``of`` the
    range of steps of each text, ``prefix`` the log-probability of what the path
    shares with an earlier one, to the right of its own steps.
    """

    place: np.ndarray
    edge: np.ndarray
    summed: np.ndarray
    of: np.ndarray
    prefix: np.ndarray

    def right_of(self, doc: np.ndarray, step: np.ndarray) -> np.ndarray:
        """The log-probability of the path's part from the end of the text to a step, that step included."""
        return self.prefix[doc] + self.summed[self.of[doc + 1]] - self.summed[step]


class Sampler:
    """Gumbel top-k over whole texts by perturbed A-star search.

    A node of the search is a set of segmentations: all that leave a known path at
    one of a range of its steps, or at one step by one of a range of edges. Its
    exact log-probability is the bound of the search, perturbed by a Gumbel
    variable that stays below its parent's score, so it is the score of the set's
    best member. The best node on a text's agenda gives the next distinct
    segmentation: the step, the edge and all to the left are drawn by their
    probabilities. What the set still holds goes back as smaller sets.

    Paths of many texts are searched at once: a path is an array over all
    characters with the lattice edge that ends there, or -1.
    """

    def __init__(self, model: bytes, samples: int, theta: float, seed: int):
        self.vocab: Vocabulary = parse(model)
        self.lattices = Lattices(self.vocab, trie=True)
        self.tables = Tables(self.lattices, theta)
        self.pieces = np.array(self.vocab.piece, object)
        self.simple = self.vocab.kind == 1
        if len(self.vocab.byte_id):  # ASCII bytes are characters by themselves
            self.pieces[self.vocab.byte_id[:128]] = [chr(k) for k in range(128)]
            self.simple[self.vocab.byte_id[:128]] = True
        self.samples, self.seed = samples, seed

    def walk(self, path: np.ndarray, node: np.ndarray, at: np.ndarray, base: np.ndarray, key: np.ndarray, begin: np.ndarray, salt: int) -> None:
        """Samples edges backward from each node (``at``: its place among all characters) to its chunk's start, into ``path``."""
        t = self.tables
        while True:
            live = np.flatnonzero(node > base)
            if not len(live):
                return
            node, at, base, key, begin = node[live], at[live], base[live], key[live], begin[live]
            aim = uniform(key, at - begin, salt)
            edge = t.first[node]
            short = np.flatnonzero(t.ladder[edge] < aim)
            while len(short):
                edge[short] += 1
                short = short[t.ladder[edge[short]] < aim[short]]
            path[at - 1] = edge
            size = t.length[edge]
            at = at - size
            node = node - size

    def _shares(self, low: np.ndarray, high: np.ndarray, but: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(range, edge, its probability at its node, first of each range) of the edges of nonempty ranges; edge ``but`` counts 0."""
        size = high - low
        first = np.cumsum(size) - size
        of = np.repeat(np.arange(len(low)), size)
        edge = np.arange(len(of)) - first[of] + low[of]
        return of, edge, np.where(edge == but[of], 0.0, np.exp(self.tables.logp[edge])), first

    def _draw(self, low: np.ndarray, high: np.ndarray, but: np.ndarray, u: np.ndarray) -> np.ndarray:
        """One edge of each range, other than ``but``, by probability."""
        of, edge, p, first = self._shares(low, high, but)
        total = np.add.reduceat(p, first)
        aim = total * u
        c = np.cumsum(p)
        c -= np.repeat((c - p)[first], high - low)
        c = np.where(p > 0, c, -1.0)
        hit = c >= np.repeat(aim, high - low)
        at = np.where(hit, np.arange(len(of)), len(of))
        picked = np.minimum.reduceat(at, first)
        # by rounding no sum may reach the aim: then the last edge with a probability
        last = np.maximum.reduceat(np.where(p > 0, np.arange(len(of)), -1), first)
        return edge[np.where(picked < len(of), picked, last)]

    def __call__(self, keys: np.ndarray, texts: list[str]) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """For each text its samples, best first: (piece ids, log-probability, perturbed score, log inclusion probability)."""
        t, n = self.tables, len(texts)
        parts = [self.lattices.chunks(x) for x in texts]
        if t.edges > _KEPT_EDGES:
            t.clear()
        key = mix64(keys.astype(np.int64).view(np.uint64) + np.uint64(self.seed))
        root = -np.log(-np.log(uniform(key, np.zeros(n, np.int64), 1)))
        chunk = t.numbers(itertools.chain.from_iterable(parts), sum(map(len, parts)))
        of = np.repeat(np.arange(n), [len(p) for p in parts])
        del parts
        size, base = t.size[chunk], t.base[chunk]
        run = np.cumsum(size)  # place where each chunk ends
        bounds = np.searchsorted(of, np.arange(n + 1))
        begin = np.concatenate([[0], run])[bounds]  # place where each text starts, and the end

        path = np.full(int(begin[-1]), -1, np.int32)
        self.walk(path, base + size, run, base, key[of], begin[of], 2)
        where, alive = root, np.arange(n)
        edge_of_stay = begin[1:].copy()  # steps that end at or before this place are new
        prefix = np.zeros(n)
        raw, paths = [], []
        drawn = np.zeros(n, np.int64)  # sets that each text has put on its agenda so far
        agenda = np.zeros((8, 0))
        out: list[list] = [[] for _ in range(n)]

        def put(rows: list[tuple[np.ndarray, ...]]) -> np.ndarray:
            """The agenda with more sets: (text, path, step or -1, low, high, log-probability, limit), those without members left out."""
            more = np.concatenate([np.stack([np.broadcast_to(np.asarray(x, np.float64), len(r[0])) for x in r]) for r in rows], axis=1)
            more = more[:, more[5] > -np.inf]
            more = more[:, np.argsort(more[0], kind="stable")]
            doc = more[0].astype(np.int64)
            place = drawn[doc] + np.arange(len(doc)) - np.searchsorted(doc, doc)
            np.add.at(drawn, doc, 1)
            e = -np.log(uniform(key[doc], place, 3))
            g = more[5] - np.logaddexp(more[5] - more[6], np.log(e))
            return np.concatenate([agenda, np.concatenate([more, g[None]])], axis=1)

        def left_out(i: Path, doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            """Log-probability of leaving a path at its steps from ``low`` to ``high``, which is nearer to the text's end."""
            right = np.where(low < high, i.right_of(doc, high), 0.0)
            inside = np.where(low < high, i.summed[high] - i.summed[low], 0.0)
            with np.errstate(divide="ignore"):
                return np.where(low < high, right + np.log(-np.expm1(inside)), -np.inf)

        for r in range(self.samples):
            raw.append(path)
            at = np.flatnonzero(path >= 0)
            edge = path[at]
            bounds = np.searchsorted(at, begin)
            at = at + 1
            logp = t.logp[edge]
            summed = np.concatenate([[0.0], np.cumsum(logp)])
            self._emit(out, alive, t.piece[edge], bounds, summed[bounds[1:]] - summed[bounds[:-1]], where, texts, at, begin)
            own = np.flatnonzero((logp < 0) & (at <= np.repeat(edge_of_stay, np.diff(bounds))))
            at, edge = at[own], edge[own]
            # running sums from the left; a step's number grows with its place
            paths.append(now := Path(at, edge, np.concatenate([[0.0], np.cumsum(logp[own])]), np.searchsorted(own, bounds), prefix))
            low, high = now.of[alive], now.of[alive + 1]
            agenda = put([(alive, r, -1, low, high, left_out(now, alive, low, high), where[alive])])
            where = np.full(n, -np.inf)
            if not agenda.shape[1]:
                break
            agenda = agenda[:, np.lexsort((-agenda[7], agenda[0]))]
            lead = np.concatenate([[True], agenda[0, 1:] != agenda[0, :-1]])
            top, agenda = agenda[:, lead], agenda[:, ~lead]
            alive, g = top[0].astype(np.int64), top[7]
            where[alive] = g
            if r == self.samples - 1:
                break
            made, step, low, high = (top[k].astype(np.int64) for k in (1, 2, 3, 4))
            u = [uniform(key[alive], np.full(len(alive), r), k) for k in (4, 5)]
            edge, left, place = np.zeros(len(alive), np.int64), np.zeros(len(alive)), np.zeros(len(alive), np.int64)
            rows = []
            for k, known in enumerate(paths):
                x = np.flatnonzero((made == k) & (step < 0))
                if len(x):  # choose the step: the path's probability from the end falls past the drawn one there
                    d, a, b = alive[x], low[x], high[x]
                    inside = known.summed[b] - known.summed[a]
                    aim = known.summed[b] - np.log1p(u[0][x] * np.expm1(inside))
                    s = np.clip(np.searchsorted(-known.summed, -aim, "right") - 1, a, b - 1)
                    rows += [(d, k, -1, a, s, left_out(known, d, a, s), g[x]), (d, k, -1, s + 1, b, left_out(known, d, s + 1, b), g[x])]
                    step[x] = s
                x2 = np.flatnonzero(made == k)
                if len(x2):
                    d, s = alive[x2], step[x2]
                    taken = known.edge[s].astype(np.int64)
                    fresh = np.isin(x2, x)
                    # the edges at a step's node: those of the node's end place
                    node = self._node_of(taken)
                    f = np.where(fresh, t.first[node], low[x2])
                    l = np.where(fresh, t.first[node + 1], high[x2])
                    e = self._draw(f, l, taken, u[1][x2])
                    right = known.right_of(d, s + 1)
                    cuts = np.sort(np.stack([np.where(fresh, taken, e), e]), axis=0)
                    for lo, hi in ((f, cuts[0]), (cuts[0] + 1, cuts[1]), (cuts[1] + 1, l)):
                        some = np.flatnonzero(lo < hi)
                        if len(some):
                            _, _, p, first = self._shares(lo[some], hi[some], np.full(len(some), -1))
                            with np.errstate(divide="ignore"):
                                mass = right[some] + np.log(np.add.reduceat(p, first))
                            rows.append((d[some], k, s[some], lo[some], hi[some], mass, g[x2][some]))
                    edge[x2], left[x2], place[x2] = e, right + t.logp[e], known.place[s]
            agenda = put(rows)
            # Steps to the right of the deviation stay; the deviating edge is taken; all to the left is sampled anew.
            path = np.full(int(begin[-1]), -1, np.int32)
            for d, k, p in zip(alive.tolist(), made.tolist(), place.tolist()):
                path[p : begin[d + 1]] = raw[k][p : begin[d + 1]]
            path[place - 1] = edge
            to = place - t.length[edge]
            prefix = np.zeros(n)
            prefix[alive] = left
            edge_of_stay = np.zeros(n, np.int64)
            edge_of_stay[alive] = to
            inside = np.searchsorted(run, place - 1, "right")  # the chunk of the deviation
            last = np.full(n, -1)
            last[alive] = inside
            whole = np.flatnonzero(np.arange(len(chunk)) < last[of])
            who = np.concatenate([of[whole], alive])
            self.walk(
                path, np.concatenate([base[whole] + size[whole], base[inside] + to - (run[inside] - size[inside])]), np.concatenate([run[whole], to]),
                np.concatenate([base[whole], base[inside]]), key[who], begin[who], 100 + 2 * r,
            )
        return [[(ids, lp, g, _inclusion(lp, where[d])) for ids, lp, g in out[d]] for d in range(n)]

    def _node_of(self, edge: np.ndarray) -> np.ndarray:
        """The node at which each edge ends."""
        t = self.tables
        return np.searchsorted(t.first[: t.nodes + 1], edge, "right") - 1

    def _emit(self, out, alive, piece, bounds, logp, where, texts, place, begin) -> None:
        for d in alive.tolist():
            a, b = bounds[d], bounds[d + 1]
            own = piece[a:b]
            odd = np.flatnonzero(own < 0)
            if len(odd):
                own = self._spelled(own, odd, place[a:b] - begin[d], texts[d])
            out[d].append((own, float(min(logp[d], 0.0)), float(where[d])))

    def _spelled(self, piece: np.ndarray, odd: np.ndarray, end: np.ndarray, text: str) -> np.ndarray:
        """Piece ids with unknown characters as their bytes, or as the unknown piece if there are no byte pieces."""
        if not len(self.vocab.byte_id):
            return np.where(piece < 0, self.vocab.unknown_id, piece)
        shift = 1 + int(self.vocab.dummy_prefix)
        raw = [text[e - shift].encode("utf-8", "replace") for e in end[odd].tolist()]
        times = np.ones(len(piece), np.int64)
        times[odd] = [len(x) for x in raw]
        ids = np.repeat(piece, times)
        ids[ids < 0] = self.vocab.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        return ids

    def decode(self, ids: np.ndarray) -> str:
        """As ``unigram.decode``; runs of ordinary pieces and ASCII bytes are joined at once."""
        v = self.vocab
        odd = ~self.simple[ids]
        if odd.any():
            edge = np.flatnonzero(np.diff(np.concatenate([[False], odd, [False]]).astype(np.int8)))
            out, at = [], 0
            plain = v._replace(dummy_prefix=False)
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                out += [*self.pieces[ids[at:a]].tolist(), decode(plain, ids[a:b].tolist())]
                at = b
            text = "".join([*out, *self.pieces[ids[at:]].tolist()])
        else:
            text = "".join(self.pieces[ids].tolist())
        text = text.replace(SPACE, " ")
        return text[1:] if v.dummy_prefix and text.startswith(" ") else text


def _inclusion(logp: float, threshold: float) -> float:
    """log P(a segmentation is among the samples | threshold) = log(1 - exp(-exp(logp - threshold)))."""
    if threshold == -np.inf:
        return 0.0
    rate = np.exp(min(logp - threshold, 700.0))
    return float(np.log(-np.expm1(-rate))) if rate > 1e-300 else float(logp - threshold)


_SCHEMA = "doc_id bigint, sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double, decoded boolean"


def _sampler(model: bytes, samples: int, theta: float, seed: int) -> Sampler:
    """One sampler for a worker's tasks, with what it remembers of chunks."""
    key = (hash(model), samples, theta, seed)
    if "sampling" not in kept or kept["sampling"][0] != key:
        kept.clear()
        kept["sampling"] = key, Sampler(model, samples, theta, seed)
    return kept["sampling"][1]


@task("sampling")
def _sample_rows(batches: Iterator[pa.RecordBatch], model: bytes, samples: int, theta: float, seed: int) -> Iterator[pa.RecordBatch]:
    sampler = _sampler(model, samples, theta, seed)
    for batch in batches:
        keys = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
        texts = [x or "" for x in batch.column(1).to_pylist()]
        at = 0
        while at < len(texts):
            some, held = at, 0
            while at < len(texts) and at - some < _ROWS and held < _CHARS:
                held += len(texts[at])
                at += 1
            row, number, ids, logp, g, inc, same = [], [], [], [], [], [], []
            for d, found in enumerate(sampler(keys[some:at], texts[some:at])):
                for k, (own, lp, perturbed, inclusion) in enumerate(found):
                    row.append(some + d)
                    number.append(k)
                    ids.append(own.astype(np.int32))
                    logp.append(round(lp, 6))
                    g.append(round(perturbed, 6))
                    inc.append(round(inclusion, 9))
                    same.append(sampler.decode(own) == texts[some + d])
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                 pa.array(logp, pa.float64()), pa.array(g, pa.float64()), pa.array(inc, pa.float64()), pa.array(same, pa.bool_())],
                names=["doc_id", "sample", "ids", "log_prob", "perturbed", "log_inclusion", "decoded"],
            )


def sample_segmentations(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL, *, samples: int = SAMPLES, theta: float = THETA, seed: int = SEED
) -> DataFrame:
    """(doc_id, sample, ids, log_prob, perturbed, log_inclusion, decoded): up to ``samples`` distinct segmentations of each whole text.

    P(segmentation) is proportional to exp(theta * its score). The samples are
    those of the ``samples`` greatest Gumbel-perturbed log-probabilities, the
    first the greatest; ``log_inclusion`` is the log-probability of being above
    the next one after them. Randomness depends only on the id and the seed, so
    repeated rows get the same samples. ``decoded`` says whether the ids decode to
    the text. A text with fewer segmentations gives all of them, with inclusion
    probability 1 (log 0); null and empty texts have the one empty segmentation; a null id is
    kept and drawn for as -1; an empty table gives no row; other columns are ignored.
    """
    with open(model_path, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").cast("string"))
    return rows.mapInArrow(lambda it: _sample_rows(it, sent.value, samples, theta, seed), _SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_segmentations(spark.read.parquet(f"{sf_dir}/documents.parquet"))

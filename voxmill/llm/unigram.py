"""Unigram vocabularies: pieces with log-probabilities, and the lattices of all ways to cut texts into pieces.

Scores are whole multiples of 1/1024, so that sums are exact and ties are real
ties in any order of addition. A unigram model's own scores are kept beside them
in single precision, in which its tokenizer adds them from the text's start.
"""

from __future__ import annotations

import itertools
import re
import struct
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np

UNIT = 1024
SPACE = "▁"
_ZIPF_SHIFT = 2.7
_UNKNOWN_PENALTY = 10
_CHUNK = re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+")


def fields(message: bytes) -> Iterator[tuple[int, int, int | bytes]]:
    """(number, wire type, value) of each field of a serialized protocol buffer."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        wire = key & 7
        if wire == 0:
            yield key >> 3, wire, varint()
        else:
            n = {1: 8, 5: 4}.get(wire) or varint()
            yield key >> 3, wire, message[at : at + n]
            at += n


class Vocabulary(NamedTuple):
    """``score`` is in units of 1/1024; ``kind`` is 1 for pieces that match text, 6 for bytes, 2 for the unknown piece, else 3.

    ``single`` are the tokenizer's float32 scores and ``single_unknown`` that of an
    unknown character, None if the model is none with scores of its own.
    """

    piece: list[str]
    score: np.ndarray
    kind: np.ndarray
    length: np.ndarray
    unknown: int  # score of a character that no piece of its own length matches
    unknown_id: int
    byte_id: np.ndarray  # of each byte, or none
    dummy_prefix: bool
    single: np.ndarray | None = None
    single_unknown: np.float32 = np.float32(0)


def parse(model: bytes) -> Vocabulary:
    """The vocabulary of a serialized SentencePiece model.

    A unigram model's scores are its log-probabilities. The scores of a BPE model
    are merge ranks; its pieces get log-probabilities by the Zipf-Mandelbrot law
    over their order, p(rank) ~ 1 / (rank + 2.7).
    """
    pieces, scores, kinds = [], [], []
    unigram, prefix = True, True
    for number, _, value in fields(model):
        if number == 1:
            own = {n: v for n, _, v in fields(value)}
            pieces.append(own.get(1, b"").decode())
            scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
            kinds.append(own.get(3, 1))
        elif number == 2:
            unigram = dict((n, v) for n, _, v in fields(value)).get(3, 1) == 1
        elif number == 3:
            prefix = bool(dict((n, v) for n, _, v in fields(value)).get(3, 1))
    kind = np.array([{1: 1, 4: 1}.get(k, k) for k in kinds])
    value = np.array(scores, np.float64)
    normal = np.flatnonzero(kind == 1)
    own, single, single_unknown = np.flatnonzero(np.array(kinds) == 1), None, np.float32(0)
    if unigram and len(own):
        single = np.array(scores, np.float32)
        single_unknown = single[own].min() - np.float32(_UNKNOWN_PENALTY)
        for k in np.flatnonzero(np.array(kinds) == 4):  # pieces of the user's own choice win over all others
            single[k] = np.float32(np.float32(len(pieces[k].encode())) * single[own].max() - 0.1)
        value[normal] = single[normal]
    if not unigram:
        weight = 1 / (np.arange(len(normal)) + _ZIPF_SHIFT)
        value[normal] = np.log(weight / weight.sum())
    score = np.round(value * UNIT).astype(np.int64)
    of_byte = np.full(256, -1, np.int64)
    for k in np.flatnonzero(kind == 6):
        of_byte[int(pieces[k][3:5], 16)] = k
    return Vocabulary(
        pieces, score, kind, np.array([len(p) for p in pieces]), int(score[normal].min()) - _UNKNOWN_PENALTY * UNIT,
        int(np.flatnonzero(kind == 2)[0]), of_byte if (of_byte >= 0).all() else np.zeros(0, np.int64), prefix, single, single_unknown,
    )


class Edges(NamedTuple):
    """All lattice edges of a run of chunks, sorted by level (end place in the chunk), chunk, then start; ``level`` parts them.

    Nodes are numbered over all chunks: chunk c has ``base[c]`` to ``base[c] +
    its length``. The piece -1 is an unknown character.
    """

    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    score: np.ndarray
    level: np.ndarray
    base: np.ndarray
    size: np.ndarray


class Trie:
    """The vocabulary's prefix tree as sorted arrays, walked from all places of a text at once."""

    def __init__(self, vocab: Vocabulary):
        number: dict[tuple[int, int], int] = {}
        final = [-1]
        for k in np.flatnonzero(vocab.kind == 1).tolist():
            at = 0
            for c in vocab.piece[k]:
                step = (at, ord(c))
                if step not in number:
                    number[step] = len(final)
                    final.append(-1)
                at = number[step]
            if at:
                final[at] = k
        self.final = np.array(final, np.int32)
        key = np.array([p << 21 | c for p, c in number], np.int64)
        child = np.array(list(number.values()), np.int32)
        order = np.argsort(key)
        self.key, self.child = key[order], child[order]
        self.root = np.zeros(1 << 21, np.int32)
        of_root = self.key < 1 << 21
        self.root[self.key[of_root]] = self.child[of_root]
        # The place of the key of each cell: -1 none, -2 several.
        cell = self._cell(self.key)
        self.slot = np.full(1 << 22, -1, np.int32)
        self.slot[cell] = np.arange(len(cell))
        held, times = np.unique(cell, return_counts=True)
        self.slot[held[times > 1]] = -2

    @staticmethod
    def _cell(key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(42)).astype(np.int64)

    def matches(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of all pieces in an array of code points."""
        at = np.arange(len(codes))
        node = self.root[codes]
        starts, ends, pieces = [], [], []
        depth = 1
        while True:
            live = np.flatnonzero(node)
            at, node = at[live], node[live]
            piece = self.final[node]
            hit = np.flatnonzero(piece >= 0)
            starts.append(at[hit])
            ends.append(at[hit] + depth)
            pieces.append(piece[hit])
            live = np.flatnonzero(at + depth < len(codes))
            at, node = at[live], node[live]
            key = node.astype(np.int64) << 21 | codes[at + depth]
            k = self.slot.take(self._cell(key))
            live = np.flatnonzero(k != -1)
            if not len(live):
                return np.concatenate(starts), np.concatenate(ends), np.concatenate(pieces).astype(np.int64)
            at, key, k = at[live], key[live], k[live]
            several = np.flatnonzero(k < 0)
            k[several] = np.minimum(np.searchsorted(self.key, key[several]), len(self.key) - 1)
            node = np.where(self.key.take(k) == key, self.child.take(k), 0)
            depth += 1


class Lattices:
    """Builds lattices; made once in each worker. Matches come from an Aho-Corasick machine, or with ``trie`` from a prefix tree."""

    def __init__(self, vocab: Vocabulary, trie: bool = False):
        self.vocab = vocab
        longest = 0
        self.separable = True
        normal = [int(k) for k in np.flatnonzero(vocab.kind == 1) if vocab.piece[k]]
        for k in normal:
            longest = max(longest, len(vocab.piece[k]))
            self.separable &= SPACE not in vocab.piece[k].lstrip(SPACE)
        if not len(vocab.byte_id):  # runs of unknown characters are one piece, across spaces if these are unknown too
            self.separable &= any(vocab.piece[k] == SPACE for k in normal)
        self.room = max(2, longest + 1)
        self.trie = Trie(vocab) if trie else None
        if not trie:
            self.machine = ahocorasick.Automaton()
            for k in normal:
                self.machine.add_word(vocab.piece[k], k)
            self.machine.make_automaton()

    def chunks(self, text: str) -> list[str]:
        """The text with marked spaces, cut where no piece can reach across."""
        if self.separable and self.vocab.dummy_prefix and text and "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " ":
            return (SPACE + text.replace(" ", " " + SPACE)).split(" ")  # as below, but faster
        marked = text.replace(" ", SPACE)
        if self.vocab.dummy_prefix and marked:
            marked = SPACE + marked
        return _CHUNK.findall(marked) if self.separable else [marked] if marked else []

    def edges(self, chunks: list[str]) -> Edges:
        vocab = self.vocab
        size = np.array([len(c) for c in chunks], np.int64)
        base = np.cumsum(size + 1) - size - 1
        last = base + size
        # Chunks are parted by one place that is in no edge.
        joined = "\n".join(chunks) + "\n"
        if self.trie:
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            codes[last] = (1 << 21) - 1
            start, end, piece = self.trie.matches(codes)
        else:
            flat = np.fromiter(itertools.chain.from_iterable(self.machine.iter(joined)), np.int64).reshape(-1, 2)
            piece = flat[:, 1]
            end = flat[:, 0] + 1
            start = end - vocab.length[piece]
            stop = np.repeat(last, size + 1)
            inside = end <= stop[start]
            start, end, piece = start[inside], end[inside], piece[inside]
        single = np.zeros(len(joined), bool)
        single[start[end - start == 1]] = True
        single[last] = True
        lone = np.flatnonzero(~single)
        start, end = np.concatenate([start, lone]), np.concatenate([end, lone + 1])
        piece = np.concatenate([piece, np.full(len(lone), -1)])
        level = end - np.repeat(base, size + 1)[start]
        order = np.argsort((level * (len(joined) + 1) + end) * self.room - (end - start))
        start, end, piece, level = start[order], end[order], piece[order], level[order]
        score = np.where(piece >= 0, vocab.score[piece], vocab.unknown)
        cuts = np.searchsorted(level, np.arange(1, int(size.max(initial=0)) + 2))
        return Edges(start, end, piece, score, cuts, base, size)

    def _costs(self, e: Edges, joined: str) -> np.ndarray:
        """Pieces of each edge: an unknown character is as many as its bytes where the vocabulary has bytes."""
        cost = np.ones(len(e.start), np.int64)
        if len(self.vocab.byte_id):
            for k in np.flatnonzero(e.piece < 0):
                cost[k] = len(joined[e.start[k]].encode("utf-8", "surrogatepass"))
        return cost

    def _counted(self, count: np.ndarray, odd: np.ndarray, start: np.ndarray, end: np.ndarray, cost: np.ndarray, unknown: np.ndarray) -> None:
        """Carries the counts along won edges; without bytes an unknown character after another adds nothing."""
        count[end] = count[start] + cost - (unknown & odd[start] if not len(self.vocab.byte_id) else 0)
        odd[end] = unknown

    def best_counts(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(best score, number of pieces) of each chunk.

        Of equally good ways to reach a place the one whose last piece starts
        first stays, as in a left-to-right search that replaces only by a
        strictly better score.
        """
        e = self.edges(chunks)
        n = int((e.size + 1).sum())
        best, count, odd = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        cost = self._costs(e, "\n".join(chunks) + "\n")
        shift = self.room.bit_length()
        for a, b in zip(e.level, e.level[1:]):
            start, end = e.start[a:b], e.end[a:b]
            key = ((best[start] + e.score[a:b]) << shift) | (end - start)
            first = np.flatnonzero(np.concatenate([[True], end[1:] != end[:-1]]))
            top = np.maximum.reduceat(key, first)
            won = np.flatnonzero(key == np.repeat(top, np.diff(np.append(first, b - a))))
            best[end[won]] = top >> shift
            self._counted(count, odd, start[won], end[won], cost[a:b][won], e.piece[a:b][won] < 0)
        done = e.base + e.size
        return best[done], count[done]

    def single_counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(best score, number of pieces) of each whole text in the tokenizer's own arithmetic.

        Sums run from the text's start, so texts are not cut. The best score at a place is
        kept in single precision; ways to it come in the order of the start of their
        last piece, and one whose sum, in double precision but for unknown characters,
        is greater than the score kept takes its place.
        """
        marked = ["".join(self.chunks(t)) for t in texts]
        e = self.edges(marked)
        n = int((e.size + 1).sum())
        best, count, odd = np.zeros(n, np.float32), np.zeros(n, np.int64), np.zeros(n, bool)
        cost = self._costs(e, "\n".join(marked) + "\n")
        known = e.piece >= 0
        score = np.where(known, self.vocab.single[e.piece], self.vocab.single_unknown)
        for a, b in zip(e.level, e.level[1:]):
            start, end, sure = e.start[a:b], e.end[a:b], known[a:b]
            term = np.where(sure, best[start].astype(np.float64) + score[a:b], (best[start] + score[a:b]).astype(np.float64))
            first = np.flatnonzero(np.concatenate([[True], end[1:] != end[:-1]]))
            size = np.diff(np.append(first, b - a))
            won = first.copy()
            kept = term[first].astype(np.float32)
            for k in range(1, int(size.max(initial=0))):
                at = np.flatnonzero(size > k)
                more = first[at] + k
                better = term[more] > kept[at]
                won[at[better]], kept[at[better]] = more[better], term[more[better]].astype(np.float32)
            best[end[won]] = kept
            self._counted(count, odd, start[won], end[won], cost[a:b][won], ~sure[won])
        done = e.base + e.size
        return best[done].astype(np.float64), count[done]


def decode(vocab: Vocabulary, ids: list[int]) -> str:
    """The text of piece ids: marked spaces are spaces, runs of byte pieces are UTF-8, the dummy prefix is taken off."""
    out = bytearray()
    for k in ids:
        kind = vocab.kind[k]
        if kind == 6:
            out.append(int(vocab.piece[k][3:5], 16))
        elif kind == 2:
            out += " ⁇ ".encode()
        elif kind == 1:
            out += vocab.piece[k].encode()
    text = out.decode("utf-8", "replace").replace(SPACE, " ")
    return text[1:] if vocab.dummy_prefix and text.startswith(" ") else text

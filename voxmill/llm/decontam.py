"""Benchmark decontamination by SimHash windows, multi-index Hamming blocks and weighted-shingle similarity."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import as_documents, cut, without_ids
from .words import find_words, shingles, text_chunks

SHINGLE = 2
RADIUS = 18
THRESHOLD = 0.5
PART_BYTES = 8 << 20
_FILTER_BITS = 22
_WINDOW_CELLS = 1 << 20
_SIGN_BITS = np.arange(64, dtype=np.uint64)


class Index(NamedTuple):
    """Items sorted by their number of words, with all that the search needs."""

    item_id: np.ndarray
    words: np.ndarray
    fingerprint: np.ndarray
    total: np.ndarray
    first: np.ndarray  # of each item in code and weight
    code: np.ndarray  # number of each item's shingles in ``known``
    known: np.ndarray  # sorted hashes of all items' shingles
    weight: np.ndarray  # of each cell of shingle hashes
    member: np.ndarray  # filter over known


def cells(value: np.ndarray) -> np.ndarray:
    """The cell of each shingle hash in the tables of weights and of known shingles, both of fixed size."""
    return (value >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def weights(items: int, having: np.ndarray) -> np.ndarray:
    """uint16: the weight of each cell, ln(1 + items / items that have a shingle of it) in 1/1024 steps; of a cell that no item has as of one.

    Weights are those of the whole benchmark, in however many parts it is searched.
    """
    return np.round(np.log1p(items / np.maximum(having, 1)) * 1024).astype(np.uint16)


def signs(value: np.ndarray) -> np.ndarray:
    """int8 (n, 64) of +1 and -1: the bits of each hash."""
    bits = (value[:, None] >> _SIGN_BITS) & np.uint64(1)
    return (bits.astype(np.int8) << 1) - 1


def pack(total: np.ndarray) -> np.ndarray:
    """The fingerprint of each row of signed sums: bit j is set where sum j is positive."""
    return ((total > 0).astype(np.uint64) << _SIGN_BITS).sum(axis=1, dtype=np.uint64)


def blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of radius + 1 blocks that cover 64 bits: equal in at least one if at most ``radius`` bits differ."""
    cuts = np.linspace(0, 64, radius + 2).astype(int)
    return [(int(a), int(b - a)) for a, b in zip(cuts, cuts[1:])]


def build_index(item_id: np.ndarray, texts: list[str], q: int, weight: np.ndarray | None = None) -> Index | None:
    """None if no item has a word. Without ``weight`` the items are the whole benchmark."""
    column = pa.array(texts, pa.large_string())
    values, sizes, ids, at = [], [], [], 0
    for a, b, data, offsets in text_chunks(column):
        words = find_words(data, offsets)
        value, _, first = shingles(words, q)
        counts = np.diff(words.first)
        for k in range(b - a):
            if first[k + 1] > first[k]:
                values.append(value[first[k] : first[k + 1]])
                sizes.append(int(counts[k]))
                ids.append(int(item_id[a + k]))
    if not ids:
        return None
    n = len(ids)
    order = np.lexsort((ids, sizes))
    values = [values[k] for k in order]
    known = np.unique(np.concatenate(values))
    if weight is None:
        weight = weights(n, np.bincount(np.concatenate([np.unique(cells(v)) for v in values]), minlength=1 << _FILTER_BITS))
    of_known = weight[cells(known)].astype(np.float64)
    first = np.concatenate([[0], np.cumsum([len(v) for v in values])])
    code = np.searchsorted(known, np.concatenate(values))
    fingerprint = np.array([pack((signs(known[c]) * of_known[c][:, None]).sum(axis=0)[None])[0] for c in np.split(code, first[1:-1])], np.uint64)
    member = np.zeros(1 << _FILTER_BITS, bool)
    member[cells(known)] = True
    total = np.add.reduceat(of_known[code], first[:-1])
    return Index(np.array(ids)[order], np.array(sizes)[order], fingerprint, total, first, code, known, weight, member)


def weighted_jaccard(code_a: np.ndarray, weight_a: np.ndarray, code_b: np.ndarray, weight_b: np.ndarray) -> float:
    """Sum of least over sum of greatest weights of two multisets of shingles; equal codes have equal weights."""
    codes, inverse = np.unique(np.concatenate([code_a, code_b]), return_inverse=True)
    n = len(codes)
    a = np.bincount(inverse[: len(code_a)], weight_a, n)
    b = np.bincount(inverse[len(code_a) :], weight_b, n)
    return float(np.minimum(a, b).sum() / np.maximum(a, b).sum())


def lookup(index: Index, value: np.ndarray) -> np.ndarray:
    """The number of each hash among the known shingles, or -1."""
    code = np.full(len(value), -1, np.int64)
    maybe = np.flatnonzero(index.member[cells(value)])
    if len(maybe):
        k = np.minimum(np.searchsorted(index.known, value[maybe]), len(index.known) - 1)
        hit = index.known[k] == value[maybe]
        code[maybe[hit]] = k[hit]
    return code


class Searcher:
    """Finds the windows of documents that match items of one index."""

    def __init__(self, index: Index, q: int, radius: int, threshold: float):
        self.index, self.q, self.radius, self.threshold = index, q, radius, threshold
        self.blocks = blocks(radius)
        self.sizes, self.of_size = np.unique(index.words, return_index=True)
        self.of_size = np.append(self.of_size, len(index.words))
        self.least = np.array([index.total[a:b].min() for a, b in zip(self.of_size, self.of_size[1:])])
        size_of = np.repeat(np.arange(len(self.sizes)), np.diff(self.of_size))
        self.tables = []
        for at, width in self.blocks:
            key = self.key(size_of, index.fingerprint, at, width)
            order = np.argsort(key, kind="stable")
            self.tables.append((np.searchsorted(key[order], np.arange((len(self.sizes) << width) + 1)), order))

    @staticmethod
    def key(size: np.ndarray, prints: np.ndarray, at: int, width: int) -> np.ndarray:
        """The block of each fingerprint together with the number of its window's size."""
        return (size.astype(np.int64) << width) | ((prints >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64)

    def candidates(self, size: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance): all pairs of one size and at most ``radius`` differing bits."""
        found = []
        for (at, width), (start, items) in zip(self.blocks, self.tables):
            key = self.key(size, prints, at, width)
            low, count = start[key], start[key + 1] - start[key]
            total = int(count.sum())
            if total:
                w = np.repeat(np.arange(len(prints)), count)
                item = items[np.arange(total) - np.repeat(np.cumsum(count) - count - low, count)]
                near = np.bitwise_count(prints[w] ^ self.index.fingerprint[item]) <= self.radius
                found.append(w[near] * len(self.index.words) + item[near])
        pair = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        w, item = pair // len(self.index.words), pair % len(self.index.words)
        return w, item, np.bitwise_count(prints[w] ^ self.index.fingerprint[item]).astype(np.int64)

    def promising(self, have: np.ndarray, room: np.ndarray) -> dict[int, np.ndarray]:
        """By size number, the first shingles of the windows that hold enough weight of benchmark shingles.

        Others cannot reach the threshold: the shared weight of a window and an
        item is at most what the window has of known shingles. ``have`` is the
        running weight, ``room`` the number of shingles to the end of a document.
        """
        out: dict[int, np.ndarray] = {}
        for k, size in enumerate(self.sizes):
            span = max(1, int(size) - self.q + 1)
            if len(room) < span:
                break
            at = np.flatnonzero(have[span:] - have[:-span] >= self.threshold * self.least[k] - 1e-6)
            at = at[room[at] >= span]
            if len(at):
                out[k] = at
        return out

    def document(self, value: np.ndarray, code: np.ndarray, n_words: int, windows: list[tuple[int, np.ndarray]]) -> list[tuple[int, int, int, float]]:
        """(item, first word, distance, similarity): for each item the most similar of the given windows, of equals the first."""
        index, q = self.index, self.q
        best: dict[int, tuple[float, int, int]] = {}
        windows = [(k, x) for k, x in windows if self.sizes[k] >= q or n_words == self.sizes[k]]
        if not windows:
            return []
        low = min(int(x[0]) for _, x in windows)
        high = max(int(x[-1]) + max(1, int(self.sizes[k]) - q + 1) for k, x in windows)
        value, code = value[low:high], code[low:high]
        weight = index.weight[cells(value)].astype(np.float64)
        summed = np.zeros((len(value) + 1, 64))
        np.cumsum(signs(value) * weight[:, None], axis=0, out=summed[1:])
        codes = np.where(code >= 0, code, len(index.known) + np.unique(value, return_inverse=True)[1])
        starts = np.concatenate([x for _, x in windows]) - low
        size = np.repeat([k for k, _ in windows], [len(x) for _, x in windows])
        spans = np.maximum(1, self.sizes[size] - q + 1)
        for at in range(0, len(starts), _WINDOW_CELLS // 64):
            some, span = starts[at : at + _WINDOW_CELLS // 64], spans[at : at + _WINDOW_CELLS // 64]
            prints = pack(summed[some + span] - summed[some])
            for w, item, distance in zip(*(x.tolist() for x in self.candidates(size[at : at + _WINDOW_CELLS // 64], prints))):
                s, e = int(some[w]), int(some[w] + span[w])
                c = index.code[index.first[item] : index.first[item + 1]]
                like = weighted_jaccard(codes[s:e], weight[s:e], c, index.weight[cells(index.known[c])].astype(np.float64))
                if like >= self.threshold - 1e-9 and (item not in best or (-like, s + low) < (-best[item][0], best[item][1])):
                    best[item] = (like, s + low, distance)
        return [(item, s, distance, like) for item, (like, s, distance) in best.items()]

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = self.index
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            out: list[tuple] = []
            for a, _, data, offsets in text_chunks(batch.column(1)):
                words = find_words(data, offsets)
                value, _, first = shingles(words, self.q)
                code = lookup(index, value)
                if not (code >= 0).any():
                    continue
                counts = np.diff(words.first)
                have = np.concatenate([[0.0], np.cumsum(np.where(code >= 0, index.weight[cells(value)].astype(np.float64), 0.0))])
                doc = np.repeat(np.arange(len(counts)), np.diff(first))
                room = first[1:][doc] - np.arange(len(value))
                by_doc: dict[int, list[tuple[int, np.ndarray]]] = {}
                for k, at in self.promising(have, room).items():
                    d = doc[at]
                    cuts = np.flatnonzero(np.diff(d)) + 1
                    for part in np.split(at, cuts):
                        by_doc.setdefault(int(doc[part[0]]), []).append((k, part - first[doc[part[0]]]))
                for d, windows in by_doc.items():
                    x, y = first[d], first[d + 1]
                    for item, s, distance, like in self.document(value[x:y], code[x:y], int(counts[d]), windows):
                        out.append((int(ids[a + d]), int(index.item_id[item]), s, int(index.words[item]), distance, round(like, 6)))
            if out:
                cols = list(zip(*out))
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types)],
                    names=["doc_id", "item_id", "first_word", "n_words", "hamming", "similarity"],
                )


_SCHEMA = "doc_id bigint, item_id bigint, first_word int, n_words int, hamming int, similarity double"


def _cell_rows(batches: Iterator[pa.RecordBatch], q: int) -> Iterator[pa.RecordBatch]:
    """(cell, n): the items of a batch with words that have a shingle of each cell; -1: all of them."""
    for batch in batches:
        for a, b, data, offsets in text_chunks(batch.column(1)):
            value, _, first = shingles(find_words(data, offsets), q)
            own = [np.unique(cells(value[first[k] : first[k + 1]])) for k in range(b - a) if first[k + 1] > first[k]]
            cell, n = np.unique(np.concatenate([np.full(len(own), -1), *own]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], names=["cell", "n"])


def benchmark_weights(items: DataFrame, q: int) -> np.ndarray:
    """The weights of the cells over all items; the driver gets one number a cell at most."""
    found = items.mapInArrow(lambda it: _cell_rows(it, q), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cell, n = found.column("cell").to_numpy(), found.column("n").to_numpy()
    having = np.zeros(1 << _FILTER_BITS, np.int64)
    having[cell[cell >= 0]] = n[cell >= 0]
    return weights(int(n[cell < 0].sum()), having)


def _parts(items: DataFrame, limit: int) -> Iterator[tuple[list[int], list[str]]]:
    """The items in runs of about ``limit`` bytes, streamed to the driver one partition at a time."""
    ids: list[int] = []
    texts: list[str] = []
    held = 0
    for row in items.toLocalIterator():
        ids.append(row.doc_id)
        texts.append(row.text)
        held += len(row.text.encode())
        if held >= limit:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    *,
    radius: int = RADIUS,
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, hamming, similarity): for each document and item that it holds, the best window.

    A window has as many words as the item and starts at any word. It is a
    candidate if its SimHash of weighted shingles differs from the item's in at
    most ``radius`` bits; blocks of the fingerprint find all of these. It counts
    if its exact weighted Jaccard similarity is at least ``threshold``; of equally
    similar windows the first is named. An item of fewer words than a shingle
    matches only a document that consists of it.

    The index is sent to all executors; its size is bounded by ``part_bytes`` of
    benchmark text, and a larger benchmark is searched in several such parts, which
    changes no result: the weights of shingles are those of the whole benchmark, in a
    table of fixed size that is sent along. Null texts are empty and
    never match; rows without an id are left out; a repeated document yields its
    rows again; an empty table gives no row; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = as_documents(docs, id_col, text_col)
    items = as_documents(benchmark, item_id_col, item_text_col).dropDuplicates(["doc_id", "text"])
    weight = benchmark_weights(items, shingle)
    out = None
    for ids, texts in _parts(items, part_bytes):
        index = build_index(np.array(ids, np.int64), texts, shingle, weight)
        if index is None:
            continue
        sent = spark.sparkContext.broadcast(index)
        part = rows.mapInArrow(lambda it, sent=sent: Searcher(sent.value, shingle, radius, threshold).rows(it), _SCHEMA)
        out = part if out is None else out.unionAll(part)
    return out if out is not None else spark.createDataFrame([], _SCHEMA)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; rows with a null id, null and empty texts are kept.

    Of a repeated id all rows go if one holds an item; ties are as in ``find_leaks``; an
    empty table stays one, and all columns stay, whatever their names.
    """
    found = cut(find_leaks(docs, benchmark, id_col, text_col, **options).select("doc_id").distinct())
    return without_ids(docs, found, id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )

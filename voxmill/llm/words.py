"""Words and word shingles of whole Arrow text columns as NumPy arrays.

A word is a maximal run of ASCII letters or digits and of bytes of non-ASCII
characters; every other ASCII character separates. All functions work on the
UTF-8 bytes of many documents at once, so no Python object per word exists.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        m = max(n, 2 * CHUNK_BYTES)
        for k, base in enumerate((_BASE, _BASE_INV)):
            p = np.full(m, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


class Words(NamedTuple):
    """Of one chunk: ``hash[i]`` of word i, its byte range, its document; ``first`` has n_docs + 1 word positions."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows with about ``limit`` bytes; a longer row comes alone."""
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        b = min(b, n)
        yield a, b, raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    n_docs = len(offsets) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, none, np.zeros(n_docs + 1, np.int64))
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IS_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    now, before = inside[1:], inside[:-1]
    start = np.flatnonzero(now[:-1] & (~before[:-1] | edge[:-1]))
    end = np.flatnonzero(before & (~now | edge))
    power, inverse = _powers_to(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:-1], out=total[1:])
    value = mix64((total[end] - total[start]) * inverse[start])
    first = np.searchsorted(start, offsets)
    return Words(value, start, end, np.repeat(np.arange(n_docs), np.diff(first)), first)


def stems(data: np.ndarray, words: Words, n: int) -> np.ndarray:
    """The hash of each word's first n bytes, other than that of a word of as many bytes."""
    if not len(words.hash):
        return np.zeros(0, np.uint64)
    power, inverse = _powers_to(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:-1], out=total[1:])
    end = np.minimum(words.start + n, words.end)
    return mix64((total[end] - total[words.start]) * inverse[words.start] ^ np.uint64(n))


def shingles(words: Words, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each shingle of q words, position of its first word, first shingle of each document + end).

    A document with 1 to q - 1 words has one shingle of all of its words; one without words has none.
    """
    counts = np.diff(words.first)
    number = np.where(counts >= q, counts - q + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(number)])
    total = int(first[-1])
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), first
    at = np.arange(total) + np.repeat(words.first[:-1] - first[:-1], number)
    room = np.repeat(counts, number)
    value = np.zeros(total, np.uint64)
    short = bool((counts[number > 0] < q).any())
    for j in range(q):
        value *= np.uint64(0xC2B2AE3D27D4EB4F)
        if short:
            value += np.where(j < room, words.hash[np.minimum(at + j, len(words.hash) - 1)], np.uint64(0))
        else:
            value += words.hash[at + j]
    return mix64(value), at, first


def numbers(seed: int, n: int) -> np.ndarray:
    """n fixed 64-bit numbers."""
    return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)) * np.uint64(0x9E3779B97F4A7C15))

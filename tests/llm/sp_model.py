"""Rewrites a SentencePiece model as a unigram model with given scores, as an oracle for the lattice operators."""

import struct

from voxmill.llm.unigram import fields


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _field(number: int, wire: int, value) -> bytes:
    key = _varint(number << 3 | wire)
    if wire == 0:
        return key + _varint(value)
    return key + (_varint(len(value)) if wire == 2 else b"") + value


def as_unigram(model: bytes, score: list[float]) -> bytes:
    out, k = b"", 0
    for number, wire, value in fields(model):
        if number == 1:
            own = {n: (w, v) for n, w, v in fields(value)}
            own[2] = (5, struct.pack("<f", score[k]))
            if own.get(3, (0, 1))[1] == 4:
                own[3] = (0, 1)
            k += 1
            value = b"".join(_field(n, w, v) for n, (w, v) in sorted(own.items()))
        elif number == 2:
            own = [(n, w, v) for n, w, v in fields(value) if n != 3] + [(3, 0, 1)]
            value = b"".join(_field(*x) for x in own)
        out += _field(number, wire, value)
    return out

"""Words and word shingles of Arrow text columns as 64-bit numbers, computed on whole batches.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D; A-Z count as a-z. The same word
has the same number in every batch, task and run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_C1, _C2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_GOLDEN = _U(0x9E3779B97F4A7C15)
_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose result looks random."""
    x = (x ^ (x >> _U(30))) * _C1
    x = (x ^ (x >> _U(27))) * _C2
    return x ^ (x >> _U(31))


def odd_constants(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _GOLDEN + _U(seed)) | _U(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where every word begins and ends (exclusive) in the bytes; no word reaches over a text's end."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    part = (data != 32) & ((data < 9) | (data > 13))
    fresh = np.zeros(n + 1, bool)
    fresh[offsets] = True
    first, last = part.copy(), part.copy()
    first[1:] &= ~part[:-1] | fresh[1:n]
    last[:-1] &= ~part[1:] | fresh[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words in order, and for each text where its words begin (one more entry at the end)."""
    data, offsets = text_bytes(column)
    begin, end = word_places(data, offsets)
    return numbers_at(data, begin, end), np.searchsorted(begin, offsets)


def numbers_at(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = len(data)
    lower = np.zeros(n + 8, np.uint8)
    lower[:n] = data
    lower[:n][(data >= 65) & (data <= 90)] += 32
    length = end - begin
    eight = np.ndarray((n + 1,), dtype="<u8", buffer=lower, strides=(1,))
    number = mix(length.astype(np.uint64) * _GOLDEN ^ (eight[begin] & _TAIL[np.minimum(length, 8)]))
    rest, at = np.flatnonzero(length > 8), 8
    while len(rest):
        piece = eight[begin[rest] + at] & _TAIL[np.minimum(length[rest] - at, 8)]
        number[rest] = mix(number[rest] * _GOLDEN + piece)
        at += 8
        rest = rest[length[rest] > at]
    return number


def shingle_numbers(numbers: np.ndarray, begins: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Per text, the number of every run of ``width`` words; of the whole sequence when it is shorter."""
    factors = odd_constants(width, 17)
    many = len(numbers) - width + 1
    runs = np.zeros(max(many, 0), np.uint64)
    for k in range(width if many > 0 else 0):
        runs += numbers[k : k + many] * factors[k]
    runs = mix(runs)
    out = []
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(runs[a : b - width + 1])
        elif b > a:
            short = np.sum(numbers[a:b] * factors[: b - a], keepdims=True, dtype=np.uint64)
            out.append(mix(short + np.full(1, b - a, np.uint64) * _GOLDEN))
        else:
            out.append(np.zeros(0, np.uint64))
    return out

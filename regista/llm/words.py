"""Words of many texts at once: byte positions and 64-bit hashes as numpy arrays.

A word is a run of bytes other than space and 0x09 to 0x0D. UTF-8 never uses those bytes inside a
character, so words are found on the encoded text. Arrow hands a task its texts as one byte buffer;
the work below walks that buffer in pieces of about :data:`PIECE_BYTES`, whatever a batch holds. A
text longer than a piece is a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 18
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_WINDOW_BASE = 0xD6E8FEB86659FD93


class Words(NamedTuple):
    """Words of texts ``first`` to ``first + texts`` of a batch."""

    first: int
    texts: int
    data: np.ndarray    # bytes of the texts, one after another
    bounds: np.ndarray  # text i is data[bounds[i]:bounds[i + 1]]
    starts: np.ndarray  # of each word, in data
    ends: np.ndarray
    text: np.ndarray    # which text (from 0) a word is in, ascending
    hashes: np.ndarray  # uint64


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that any of their bits may be used alone."""
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and its inverse modulo 2 ** 64, for i below ``size``."""
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        factors = np.full(size, b, np.uint64)
        factors[0] = 1
        both.append(np.multiply.accumulate(factors))
    return both[0], both[1]


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(base, 1 << max(16, (size - 1).bit_length()))


def _sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=out[1:])
    return out


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the bounds of its texts; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, bounds, data = column.buffers()
    kind = np.int64 if wide else np.int32
    bounds = np.frombuffer(bounds, kind)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, kind)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), bounds.astype(np.int64)


def pieces(column: pa.Array, lower: bool = False, most: int = PIECE_BYTES) -> Iterator[Words]:
    """The words of a batch's texts, piece by piece; ``lower`` lower-cases A to Z first."""
    data, bounds = text_buffer(column)
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1)
        yield _words(first, data[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first], lower)
        first = last


def _words(first: int, data: np.ndarray, bounds: np.ndarray, lower: bool) -> Words:
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    word = ~gap
    fresh = word.copy()
    fresh[1:] &= gap[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    fresh[inner] = word[inner]
    last = word.copy()
    last[:-1] &= gap[1:]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(fresh), np.flatnonzero(last) + 1
    up, down = powers(_BASE, len(data) + 1)
    sums = _sums(_byte_values()[data] * up[:len(data)])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    text = np.searchsorted(bounds, starts, side="right") - 1
    return Words(first, len(bounds) - 1, data, bounds, starts, ends, text, hashes)


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each ``length`` consecutive values; entry i is for i to i + length - 1."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    up, down = powers(_WINDOW_BASE, len(hashes))
    sums = _sums(hashes * up[:len(hashes)])
    return mixed((sums[length:] - sums[:-length]) * down[:len(hashes) - length + 1])


def same_text(text: np.ndarray, length: int) -> np.ndarray:
    """Which runs of ``length`` words lie within one text."""
    if len(text) < length:
        return np.zeros(0, bool)
    return text[length - 1:] == text[:len(text) - length + 1]

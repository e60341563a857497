"""Words of Arrow text columns as 64-bit hashes, computed over whole byte buffers with numpy.

Byte classes are enough for the word patterns used here: every byte of a non-ASCII character
is a word byte, so words of code points and words of UTF-8 bytes have the same borders.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_MASK = (1 << 64) - 1


def _byte_class(separators: list[tuple[int, int]]) -> np.ndarray:
    out = np.ones(256, dtype=bool)
    for a, b in separators:
        out[a : b + 1] = False
    return out


#: Words of anything but space and \t..\r.
SPACED = _byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: Words of digits, letters and everything outside ASCII.
ALNUM = _byte_class([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all bits of a uint64 array; makes a new array."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


@dataclass
class Words:
    """Words of several texts in a row: first[i]..first[i+1] are those of text i."""

    first: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def _powers(n: int, p: int) -> np.ndarray:
    out = np.full(n, p, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the n+1 borders of a text column; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :] if at is not None and len(column) else np.zeros(len(column) + 1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw, offsets


def pieces(offsets: np.ndarray, most: int = 250_000) -> Iterator[tuple[int, int]]:
    """Runs of texts of about that many bytes; a longer text is a run of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = j


def words(raw: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray) -> Words:
    """Lower-cased (A-Z) words of the texts between the offsets."""
    base = int(offsets[0])
    data = raw[base : int(offsets[-1])]
    n = len(data)
    marks = np.zeros(n + 1, dtype=bool)
    marks[offsets - base] = True  # a text border ends a word
    inside = word_byte[data]
    starts = np.flatnonzero(inside & (np.concatenate(([True], ~inside[:-1])) | marks[:-1])) if n else np.zeros(0, dtype=np.int64)
    ends = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | marks[1:])) + 1 if n else starts
    power = _powers(n + 1, _P)
    values = np.where(inside, _LOWER[data].astype(np.uint64) + np.uint64(1), np.uint64(0))
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * power[:n], out=sums[1:])
    back = _powers(n + 1, _P_INV)
    hashes = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    return Words(np.searchsorted(starts, offsets - base), hashes, starts, ends)


_STEP = [np.uint64((0xA24BAED4963EE407 * (2 * k + 1) ** 5 + 0x9FB21C651E98DF25 * k) & _MASK | 1) for k in range(64)]


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each position of several parallel hash arrays; order matters."""
    out = np.full(len(parts[0]), np.uint64(len(parts) * 0x9E3779B1), dtype=np.uint64)
    for k, part in enumerate(parts):
        out += mix(part + _STEP[k]) * _STEP[k]
    return mix(out)


def shingle_sets(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text's word shingles, one after another, and their n+1 borders.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    count = len(w.hashes)
    whole = combine([w.hashes[k : count - size + 1 + k] for k in range(size)]) if count >= size else np.zeros(0, dtype=np.uint64)
    sets = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= size:
            sets.append(np.unique(whole[a : b - size + 1]))
        elif b > a:
            sets.append(combine([w.hashes[k : k + 1] for k in range(a, b)]))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    borders = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)), borders

"""Hashes of words for many texts at once, in array operations over their bytes.

A word is a run of bytes other than space and tab to carriage return; A to Z count as a to z. A word's hash is a
polynomial over its bytes, taken from prefix sums of one pass over all bytes. Memory is bounded by the piece that is
looked at, whatever the length of a text, and by eight bytes for each word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

#: Bytes looked at together.
PIECE = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64 over all others."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(1)
def byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
    values[65:91] = values[97:123]
    return values


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)])) for b in (_BASE, inverse))


def _is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word in `data`."""
    edge = np.diff(np.concatenate([[True], _is_space(data), [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, inverse = _powers(1 << max(PIECE + 4096, len(data)).bit_length())
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_values()[data] * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)), starts


def _pieces(data: bytes) -> Iterator[bytes]:
    """A long text, cut at white space."""
    low = 0
    while len(data) - low > PIECE:
        high = low + PIECE
        while high < len(data) and not (data[high] == 32 or 9 <= data[high] <= 13):
            high += 1
        yield data[low:high]
        low = high
    yield data[low:]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and for each text (and after the last) where its words begin among them."""
    found: list[np.ndarray] = []
    counts = np.zeros(len(texts), np.int64)
    held: list[bytes] = []
    size, first = 0, 0

    def flush() -> None:
        if held:
            lengths = np.array([len(x) + 1 for x in held])
            hashes, starts = _hashes(np.frombuffer(b"\n".join(held), np.uint8))
            counts[first : first + len(held)] = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)])))
            found.append(hashes)

    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass")
        if held and size + len(data) > PIECE:
            flush()
            held, size, first = [], 0, i
        if len(data) > PIECE:
            for piece in _pieces(data):
                hashes, _ = _hashes(np.frombuffer(piece, np.uint8))
                found.append(hashes)
                counts[i] += len(hashes)
            first = i + 1
        else:
            held.append(data)
            size += len(data)
    flush()
    hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
    return hashes, np.concatenate([[0], np.cumsum(counts)])


def windows(hashes: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of `width` consecutive words that lie in one text, and where each text's windows begin."""
    counts = np.maximum(np.diff(starts) - width + 1, 0)
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    joined = np.zeros(n, np.uint64)
    for k in range(width):
        joined = joined * _ODD + hashes[k : k + n]
    inside = np.zeros(len(hashes) + 1, np.int32)
    full = counts > 0
    np.add.at(inside, starts[:-1][full], 1)
    np.add.at(inside, starts[:-1][full] + counts[full], -1)
    return mix(joined[np.cumsum(inside)[:n] > 0]), np.concatenate([[0], np.cumsum(counts)])


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted, each value once. np.unique goes by a hash table, whose many small parts stay with a process that does it often."""
    x = np.sort(x)
    first = np.ones(len(x), bool)
    first[1:] = x[1:] != x[:-1]
    return x[first]


def text_slices(texts: Iterable[str], size: int) -> Iterator[tuple[int, int]]:
    """Consecutive texts with about `size` characters together.

    Not by the texts' `.str`, which refers to them and they to it: a batch would stay until Python looks for such cycles.
    """
    return slices(np.array([len(t) for t in texts], np.int64), size)


def slices(lengths: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Consecutive items whose lengths add up to about `size`, at least one at a time."""
    ends = np.cumsum(lengths)
    low = 0
    while low < len(ends):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + size, "right")))
        yield low, high
        low = high

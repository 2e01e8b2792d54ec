"""Words of Arrow text columns as numpy arrays, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once; a longer text is handled alone.
SLICE_BYTES = 1 << 20

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Separators of words ``[^\x20\x09-\x0D]+``.
SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))
#: Separators of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
NOT_ALNUM = byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the offsets of each row; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(off: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        yield a, b
        a = b


class Words:
    """Start and end byte of each word; ``of[d]:of[d + 1]`` are the words of row d."""

    def __init__(self, data: np.ndarray, off: np.ndarray, separators: np.ndarray = SPACES):
        self.data, self.off = data, off
        n = len(data)
        inside = ~separators[data]
        first = np.zeros(n, bool)
        last = np.zeros(n, bool)
        if n:
            first[0], last[-1] = inside[0], inside[-1]
            np.logical_and(inside[1:], ~inside[:-1], out=first[1:])
            np.logical_and(inside[:-1], ~inside[1:], out=last[:-1])
            edge = off[off < n]
            first[edge] = inside[edge]
            edge = off[off > 0] - 1
            last[edge] = inside[edge]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.of = np.searchsorted(self.start, off)

    def hashes(self, fold: np.ndarray = ASCII_LOWER) -> np.ndarray:
        """A 64-bit hash of each word's bytes, taken through ``fold``."""
        n = len(self.data)
        power = np.full(n + 1, _ODD, np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[fold][self.data] * power[:n], out=total[1:])
        inverse = np.full(n + 1, _ODD_INV, np.uint64)
        inverse[0] = 1
        np.multiply.accumulate(inverse, out=inverse)
        raw = (total[self.end] - total[self.start]) * inverse[self.start]
        return mix(raw ^ (self.end - self.start).astype(np.uint64))


def hash_word(word: str) -> int:
    """The hash that ``Words.hashes`` gives a word."""
    data = np.frombuffer(word.encode(), np.uint8)
    w = Words(data, np.array([0, len(data)]), np.zeros(256, bool))
    return int(w.hashes()[0])


def shingles(h: np.ndarray, of: np.ndarray, k: int) -> list[np.ndarray]:
    """Each row's set of k-word shingles as sorted distinct 64-bit hashes.

    With fewer than k words the whole sequence is the one shingle; without
    words the set is empty.
    """
    factors = mix(np.arange(1, k + 1, dtype=np.uint64) * _ODD) | np.uint64(1)
    n = len(h)
    whole = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k):
        whole += h[j : j + len(whole)] * factors[j]
    whole = mix(whole)
    out = []
    for a, b in zip(of[:-1].tolist(), of[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(whole[a : b - k + 1]))
        elif b > a:
            few = (h[a:b] * factors[: b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(few + np.uint64(b - a)))
        else:
            out.append(h[:0])
    return out

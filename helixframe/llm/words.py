"""Words of many texts at once, as numpy arrays: places in a byte buffer and 64-bit hashes.

Words are runs of bytes other than U+0020 and U+0009 to U+000D, which are single bytes in UTF-8
and never part of another character.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text hashed together; one longer text is taken alone.
BLOCK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MIX = np.random.Generator(np.random.PCG64(20)).integers(0, 2**64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C17
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_powers = {b: np.ones(1, np.uint64) for b in (_BASE, _BASE_INVERSE)}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1); as many as a block needs are remembered."""
    if len(_powers[base]) < n:
        all_ = np.full(max(n, BLOCK + 1), base, np.uint64)
        all_[0] = 1
        all_ = np.multiply.accumulate(all_)
        if n > BLOCK + 1:
            return all_
        _powers[base] = all_
    return _powers[base][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each values[start:end], the same wherever it stands; ends are above starts."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(_BASE, len(values)), out=total[1:])
    return mixed((total[ends] - total[starts]) * _power(_BASE_INVERSE, len(values) + 1)[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words of a text, a block of its bytes at a time, however long it is; a longer word is taken alone."""
    if not len(starts) or ends[-1] - starts[0] <= BLOCK:
        return range_hashes(_MIX[data], starts, ends) if len(starts) else np.zeros(0, np.uint64)
    found = []
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        low = starts[i]
        found.append(range_hashes(_MIX[data[low : ends[j - 1]]], starts[i:j] - low, ends[i:j] - low))
        i = j
    return np.concatenate(found)


@dataclass
class Words:
    rows: np.ndarray  # rows of the batch that this block holds
    data: bytes  # their texts, one after the other
    starts: np.ndarray  # of each word in data
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # of each row, its first word; one more at the end
    at: np.ndarray  # of each row, where its text begins in data; one more at the end


def word_blocks(texts: pa.Array, lower: bool = False, blank: Callable[[np.ndarray], np.ndarray] = _SPACE.__getitem__, block: int = BLOCK) -> Iterator[Words]:
    """Words of a string column, some rows (a block of bytes, or one longer text) at a time; blank marks the bytes that are white space."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8) if len(texts) else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + block, "right")) - 1)
        part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        if lower:
            part = _LOWER[part]
        inside = ~blank(part)
        begins, finishes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        finishes[:-1] &= ~inside[1:]
        full = at[:-1][at[:-1] < at[1:]]
        begins[full] = inside[full]
        last = at[1:][at[:-1] < at[1:]] - 1
        finishes[last] = inside[last]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
        yield Words(np.arange(i, j), part.tobytes(), starts, ends, word_hashes(part, starts, ends), np.searchsorted(starts, at), at)
        i = j


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on (of the words of one block, row borders not seen)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total, factor = np.zeros(len(hashes) - n + 1, np.uint64), 1
    for k in range(n):
        total += hashes[k : len(hashes) - n + 1 + k] * np.uint64(factor)
        factor = factor * _BASE % 2**64
    return mixed(total)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of the width values from each place on."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x

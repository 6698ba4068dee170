"""Texts of an Arrow batch as one byte array, and words and shingles of all of them at once as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLOCK = 1 << 21  # bytes hashed at a time
_U = np.uint64


def _splitmix(n: int, seed: int) -> np.ndarray:
    """n numbers of the splitmix64 sequence."""
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


def mixed(h: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64: every bit depends on every other."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BYTE = _splitmix(256, 17)  # a number for each byte value
_BASE = int(_splitmix(1, 5)[0]) | 1
_PLACE = _splitmix(64, 29) | _U(1)  # odd factors for the places in a shingle
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def powers(n: int) -> np.ndarray:
    """_BASE to the power of 0 .. n-1, modulo 2**64."""
    p = np.full(n, _BASE, dtype=_U)
    p[:1] = 1
    return np.multiply.accumulate(p)


def inverse_powers(n: int) -> np.ndarray:
    p = np.full(n, pow(_BASE, -1, 1 << 64), dtype=_U)
    p[:1] = 1
    return np.multiply.accumulate(p)


_POWERS, _INVERSE = powers(_BLOCK), inverse_powers(_BLOCK)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after the other, and the offset of each (one more at the end). Null is empty."""
    if pa.types.is_dictionary(texts.type):
        texts = texts.dictionary_decode()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``limit`` bytes of text, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def _hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of data[start:end] for each word."""
    out = np.zeros(len(starts), dtype=_U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _BLOCK, side="right")))
        low, high = int(starts[i]), int(ends[j - 1])
        n = high - low
        up, down = (_POWERS, _INVERSE) if n <= _BLOCK else (powers(n), inverse_powers(n))
        total = np.zeros(n + 1, dtype=_U)
        np.cumsum(_BYTE[data[low:high]] * up[:n], out=total[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (total[e] - total[s]) * down[s]
        i = j
    return mixed(out + (ends - starts).astype(_U))


@dataclass(frozen=True)
class Words:
    """Words of several texts: their hashes, and the number of the first word of each text (one more at the end)."""

    hashes: np.ndarray
    first: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` after A-Z became a-z. A word ends with its text."""
    lower = _LOWER[data]
    inside = ~_IS_SPACE[lower]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    before[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(_hash_words(lower, starts, ends), np.searchsorted(starts, offsets))


def runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    """Maximal runs of the byte values that are True in ``inside``, after A-Z became a-z. A run ends with its text."""
    lower = _LOWER[data]
    own = np.zeros(len(data) + 2, dtype=np.int8)
    own[1:-1] = inside[data]
    steps = np.diff(own)
    begins, ends = steps[:-1] == 1, steps[1:] == -1
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edge] |= own[edge + 1] == 1
    ends[edge - 1] |= own[edge] == 1
    starts = np.flatnonzero(begins)
    return Words(_hash_words(lower, starts, np.flatnonzero(ends) + 1), np.searchsorted(starts, offsets))


def shingle_hashes(w: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words of one text; of all its words if it has fewer; none if it has none."""
    n = len(w) - size + 1
    if n >= 1:
        total = np.zeros(n, dtype=_U)
        for j in range(size):
            total += w[j : j + n] * _PLACE[j]
        return mixed(total)
    if not len(w):
        return w
    return mixed(np.array([np.sum(w * _PLACE[: len(w)]) + _U(len(w))], dtype=_U))


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = text_bytes(texts)
    found = words(data, offsets)
    hashes, first = found.hashes, found.first
    runs = shingle_hashes(hashes, size) if len(hashes) >= size else np.zeros(0, dtype=_U)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        out.append(np.unique(runs[a : b - size + 1] if b - a >= size else shingle_hashes(hashes[a:b], size)))
    return out


def intersection_size(a: np.ndarray, b: np.ndarray) -> int:
    """Of two sorted arrays of distinct values."""
    if not len(a) or not len(b):
        return 0
    at = np.searchsorted(b, a)
    return int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))

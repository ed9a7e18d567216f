"""Words of a batch of texts and their 64-bit hashes, computed on whole byte arrays.

A word is a run of bytes outside the separators. Separators are ASCII, so cutting UTF-8 bytes
cuts code points correctly. The hash of a word is a polynomial over its bytes, taken from
prefix sums, then mixed; equal words have equal hashes in every process.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = bytes([0x20, *range(0x09, 0x0E)])
#: Everything in ASCII but letters and digits.
NOT_ALNUM = bytes(b for b in range(128) if not chr(b).isalnum())

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    z = x + np.uint64((seed * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


_BYTE = mix(np.arange(256, dtype=np.uint64), 7)


def _table(separators: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(separators)] = True
    return table


def _geometric(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least `n` of each; kept and grown per process."""
    while len(_powers[0]) < n:
        size = len(_powers[0])
        for k, base in enumerate((_BASE, _INVERSE)):
            _powers[k] = np.concatenate([_powers[k], _powers[k] * np.uint64(pow(base, size, 1 << 64))])
    return _powers[0], _powers[1]


def polynomial(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each byte range, equal for equal bytes."""
    n = len(data)
    power, inverse = _geometric(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:n], out=total[1:])
    return (total[end] - total[start]) * inverse[start]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (null: none) and where each starts, with the end."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    base = int(offsets[0]) if len(offsets) else 0
    data = np.frombuffer(data, np.uint8)[base : int(offsets[-1])] if data is not None and len(texts) else np.zeros(0, np.uint8)
    return data, offsets - base


@dataclass
class Words:
    """`start`, `end`: bytes in `data`; `first`: index of each text's first word, one more entry than texts."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def of(self, text: int) -> slice:
        return slice(int(self.first[text]), int(self.first[text + 1]))


def split(texts: pa.Array, lower: bool = False, separators: bytes = SPACE) -> Words:
    """Words of each text (null: none); `lower` maps A-Z to a-z first."""
    data, offsets = text_bytes(texts)
    if lower:
        table = np.arange(256, dtype=np.uint8)
        table[65:91] += 32
        data = table[data]
    n = len(data)
    gap = _table(separators)[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.ones(n, bool)
    before[1:] = gap[:-1]
    before |= edge[:n]
    start = np.flatnonzero(~gap & before)
    after = np.ones(n, bool)
    after[:-1] = gap[1:]
    after |= edge[1:]
    end = np.flatnonzero(~gap & after) + 1
    value = polynomial(data, start, end) + (end - start).astype(np.uint64)
    return Words(data, start, end, np.searchsorted(start, offsets), mix(value))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of `n` consecutive words."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:m].copy()
    for k in range(1, n):
        total *= np.uint64(0xFF51AFD7ED558CCD)
        total += hashes[k : k + m]
    return mix(total, n)

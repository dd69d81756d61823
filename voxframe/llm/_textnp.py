"""Vectorised word and shingle hashing over the buffers of Arrow string columns.

Words are the maximal runs of bytes outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased. All work is
done on the UTF-8 bytes of a whole batch; memory is a small multiple of one segment plus eight bytes
a word, however long a text is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values() -> np.ndarray:
    lowered = np.arange(256)
    lowered[ord("A") : ord("Z") + 1] += 32
    return mix(lowered.astype(np.uint64), 7) | np.uint64(1)


BYTE_VALUE = _byte_values()
_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        step = np.full(n, base, dtype=np.uint64)
        step[0] = 1
        have = np.cumprod(step, dtype=np.uint64)
        if n <= 2 * SEGMENT:
            _POWERS[name] = have
    return have


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the n + 1 offsets; null rows are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all words in order: hash, length in bytes; and the n + 1 offsets of each row's words."""
    hashes, lengths, starts_at = [], [], []
    bounds = np.zeros(len(data) + 1, dtype=bool)
    bounds[offsets] = True
    a, n = 0, len(data)
    while a < n:
        b = min(n, a + SEGMENT)
        while b < n and not bounds[b] and not SEPARATOR[data[b]]:
            ahead = np.flatnonzero(SEPARATOR[data[b : b + SEGMENT]] | bounds[b : min(n, b + SEGMENT)])
            b = b + int(ahead[0]) if len(ahead) else min(n, b + SEGMENT)
        part = data[a:b]
        inside = ~SEPARATOR[part]
        before = np.empty_like(inside)
        before[0] = False
        before[1:] = inside[:-1]
        first = np.flatnonzero(inside & (~before | bounds[a:b]))
        after = np.empty_like(inside)
        after[-1] = False
        after[:-1] = inside[1:]
        cut = bounds[a + 1 : b + 1]
        last = np.flatnonzero(inside & (~after | cut)) + 1
        if len(first):
            sums = np.empty(len(part) + 1, dtype=np.uint64)
            sums[0] = 0
            np.cumsum(BYTE_VALUE[part] * _powers("up", _ODD, len(part))[: len(part)], out=sums[1:])
            hashes.append(mix((sums[last] - sums[first]) * _powers("down", _INVERSE, len(part))[first], 3))
            lengths.append(last - first)
            starts_at.append(first + a)
        a = b
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    at = np.concatenate(starts_at)
    return np.concatenate(hashes), np.concatenate(lengths), np.searchsorted(at, offsets)


def shingles(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of one row's word shingles; of fewer words, one of the whole sequence."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64)
    size = min(n, width)
    total = np.full(n - size + 1, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        total = total * np.uint64(0xD6E8FEB86659FD93) + mix(hashes[k : n - size + 1 + k], 11)
    return np.unique(mix(total, 13))

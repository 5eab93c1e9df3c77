"""Words of many texts as 64-bit hashes, with vectorised byte operations.

Words are runs of bytes other than space and tab to carriage return, A-Z
lower-cased.  A word's hash is a polynomial over its bytes modulo 2^64, read
from one running sum over the buffer, and then mixed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_U = np.uint64
_PIECE = 1 << 19          # bytes hashed at once
_LONG_WORD = 1 << 22      # longer words are hashed one by one

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_rng = np.random.default_rng(20240131)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_VALUE[ord("A"):ord("Z") + 1] = _VALUE[ord("a"):ord("z") + 1]
_BASE = int(_rng.integers(1, 2**62)) * 4 + 3
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(max(n, _PIECE), np.uint64)
        have[1:] = _U(base)
        _powers[base] = have = np.multiply.accumulate(have)
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every bit of the result depends on every bit of x."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums, one longer than ``values``; see ``span_hash``."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(_BASE, len(values))[:len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end], whatever the position."""
    return (sums[end] - sums[start]) * _power(_INVERSE, len(sums))[start]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array without nulls, and the offset of each text plus the end."""
    texts = texts.cast(pa.large_binary())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def word_bounds(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; words never cross texts."""
    word = ~_SPACE[raw]
    before, after = np.zeros(len(word), bool), np.zeros(len(word), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    inner = at[(at > 0) & (at < len(raw))]
    before[inner] = False
    after[inner - 1] = False
    return np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1


def hash_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the index of each text's first word plus the end."""
    raw, at = buffers(texts)
    start, end = word_bounds(raw, at)
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _PIECE, "right")))
        a, b = start[i], end[j - 1]
        if b - a > _LONG_WORD:
            out[i] = xxhash.xxh3_64_intdigest(raw[a:b].tobytes().lower())
        else:
            sums = prefix_sums(_VALUE[raw[a:b]])
            out[i:j] = span_hash(sums, start[i:j] - a, end[i:j] - a)
        i = j
    return mixed(out), np.searchsorted(start, at)


def combined(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for a sequence of hashes, in order."""
    total = np.full(len(parts[0]), _U(len(parts)), np.uint64)
    for k, p in enumerate(parts):
        total = total + p * _U((0x9E3779B97F4A7C15 * (2 * k + 3)) % 2**64 | 1)
    return mixed(total)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Per text: sorted distinct hashes of its n-word shingles; a shorter text is one shingle, an empty one has none."""
    words, at = hash_words(texts)
    grams = (combined([words[k:len(words) - n + 1 + k] for k in range(n)]) if len(words) >= n
             else np.zeros(0, np.uint64))
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= n:
            out.append(distinct(grams[a:b - n + 1]))
        elif b > a:
            out.append(combined([words[a + k:a + k + 1] for k in range(b - a)]))
        else:
            out.append(words[:0])
    return out

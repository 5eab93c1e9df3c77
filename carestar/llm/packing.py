"""Compact bytes for arrays that travel between tasks."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(x: np.ndarray, ordered: bool = False) -> bytes:
    """An integer array byte plane by byte plane; of an ordered one the differences."""
    if ordered and len(x):
        x = np.concatenate([x[:1], x[1:] - x[:-1]])
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, kind: type, ordered: bool = False) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    x = np.ascontiguousarray(planes.T).view(kind).ravel()
    return np.cumsum(x, dtype=kind) if ordered else x

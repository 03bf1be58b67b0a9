"""Columns of numbers as compressed byte planes, and ranges of hashes."""

from __future__ import annotations

import numpy as np


def pack(values: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed."""
    import zstandard

    width = values.dtype.itemsize
    planes = values.astype(values.dtype.newbyteorder("<")).view(np.uint8).reshape(-1, width).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    import zstandard

    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(np.dtype(kind).newbyteorder("<")).reshape(-1).astype(kind)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def range_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)

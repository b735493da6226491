"""Arrays as small byte strings: what blocks of documents send through a shuffle."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(a: np.ndarray) -> bytes:
    """Integers, byte plane by byte plane, compressed."""
    if not len(a):
        return b""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return a.dtype.char.encode() + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes | None, kind: type) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    dtype = np.dtype(data[:1].decode())
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def pack_rising(a: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit numbers, as their differences."""
    return pack(np.diff(a, prepend=np.uint64(0)))


def unpack_rising(data: bytes | None) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def pack_strings(words: list[bytes]) -> bytes:
    size = np.fromiter(map(len, words), np.uint32, len(words))
    return zstandard.ZstdCompressor(level=6).compress(np.uint32(len(words)).tobytes() + size.tobytes() + b"".join(words))


def unpack_strings(data: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    end = (4 + 4 * n + np.cumsum(np.frombuffer(raw, np.uint32, n, 4))).tolist()
    return [raw[a:b] for a, b in zip([4 + 4 * n, *end], end)]


def by_count(numbers: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Renumbers 0..n-1 so that common numbers are small: the new numbers, and the old ones in new order."""
    order = np.argsort(-np.bincount(numbers, minlength=n), kind="stable")
    new = np.empty(n, np.uint32)
    new[order] = np.arange(n, dtype=np.uint32)
    return new[numbers], order

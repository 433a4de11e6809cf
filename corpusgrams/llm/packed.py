"""Arrays of small numbers as compressed bytes, for columns of block tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack_numbers(x: np.ndarray) -> bytes:
    """Non-negative 32-bit numbers, compressed: their first, second, ... bytes together."""
    planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack_numbers(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel()

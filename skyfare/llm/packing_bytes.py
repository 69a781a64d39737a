"""Compact bytes for sorted 48-bit tokens."""

from __future__ import annotations

import numpy as np

TOKEN_BITS = 48


def pack(tokens: np.ndarray) -> bytes:
    """Ascending uint64 values as byte planes of their differences."""
    steps = np.diff(tokens, prepend=np.uint64(0))
    if not len(steps) or steps.max() < 1 << 32:
        steps = steps.astype(np.uint32)
    width = steps.dtype.itemsize
    return bytes([width]) + np.ascontiguousarray(steps.view(np.uint8).reshape(-1, width).T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    steps = np.ascontiguousarray(planes.T).view(np.uint32 if width == 4 else np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def narrow(tokens: np.ndarray) -> bytes:
    """48-bit values in any order, six bytes each."""
    return np.ascontiguousarray(tokens.astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def widen(data: bytes) -> np.ndarray:
    six = np.frombuffer(data, np.uint8).reshape(-1, 6)
    wide = np.zeros((len(six), 8), np.uint8)
    wide[:, :6] = six
    return wide.view(np.uint64).ravel()

"""Numbers in bytes, and numbers for keys."""

from __future__ import annotations

import numpy as np


class Numbers(dict):
    """Numbers new keys in their order."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def planes(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, so that their empty high bytes compress away."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    """The numbers of this numpy kind again."""
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()

"""Sorted 64-bit values on their way to buckets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def pack(values: np.ndarray) -> bytes:
    """Sorted 64-bit values as differences of six bytes, or of eight if one is too
    large for that; the first difference is the first value."""
    steps = np.diff(values, prepend=np.uint64(0))
    wide = steps[1:].max(initial=0) >> np.uint64(48)
    head = values[:1].tobytes()
    raw = steps[1:].view(np.uint8).reshape(-1, 8)
    return head + (raw if wide else raw[:, :6]).tobytes()


def unpack(data: bytes, n: int) -> np.ndarray:
    raw = np.zeros((n, 8), np.uint8)
    raw[0] = np.frombuffer(data, np.uint8, 8)
    if n > 1:
        body = np.frombuffer(data, np.uint8, offset=8).reshape(n - 1, -1)
        raw[1:, :body.shape[1]] = body
    return np.cumsum(raw.view(np.uint64).ravel(), dtype=np.uint64)


def bucket_bounds(buckets: int) -> np.ndarray:
    """First value of each bucket, and an end beyond all values but the last."""
    step = (1 << 64) // buckets
    return np.array([i * step for i in range(buckets)] + [(1 << 64) - 1], np.uint64)


def filled_buckets(values: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, first, end) of the buckets that hold any of the sorted ``values``, by the bounds of ``bucket_bounds``.

    The work grows with the values, not with the number of buckets.
    """
    if not len(values):
        return
    owner = np.zeros(len(values), np.uint64)
    if buckets > 1:
        owner = np.minimum(values // np.uint64((1 << 64) // buckets), np.uint64(buckets - 1))
    heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    for first, end in zip(heads, np.append(heads[1:], len(owner))):
        yield int(owner[first]), int(first), int(end)

"""Keys along a Hilbert curve, for whole arrays of points."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the curve of each row of ``cells`` (points x axes, 0 .. 2**bits - 1).

    The curve is followed cube by cube: at every level the axes are exchanged and
    reflected so that neighbouring cubes share a face, then the levels' corner
    numbers (in Gray code) are strung together. Needs ``axes * bits <= 63``.
    """
    points = cells.astype(np.int64).T.copy()
    axes = len(points)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in range(axes):
            reflected = (points[axis] >> level) & 1 == 1
            swap = np.where(reflected, 0, (points[0] ^ points[axis]) & low)
            points[0] = np.where(reflected, points[0] ^ low, points[0] ^ swap)
            points[axis] ^= swap
    for axis in range(1, axes):
        points[axis] ^= points[axis - 1]
    carry = np.zeros(points.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        carry ^= np.where((points[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    points ^= carry
    keys = np.zeros(points.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(axes):
            keys = (keys << 1) | ((points[axis] >> level) & 1)
    return keys

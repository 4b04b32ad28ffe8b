"""Cells of a sketch on their way from task to task, in pieces of PIECE_CELLS."""

from __future__ import annotations

import numpy as np

PIECE_CELLS = 1 << 18


def gaps(cells: np.ndarray) -> bytes:
    """Sorted cells as one byte each: the step from the one before, 255 for each 255 that are skipped."""
    step = np.diff(cells, prepend=-1) - 1
    skip = step // 255
    out = np.full(int(skip.sum()) + len(step), 255, np.uint8)
    out[np.cumsum(skip + 1) - 1] = step % 255
    return out.tobytes()


def from_gaps(packed: bytes) -> np.ndarray:
    step = np.frombuffer(packed, np.uint8).astype(np.int64)
    here = step < 255
    return (np.cumsum(step + here) - 1)[here]


def cells_for(items: int, most: int) -> int:
    """A power of two, `items` or more up to `most`, and a piece at least."""
    cells = PIECE_CELLS
    while cells < min(most, items):
        cells *= 2
    return cells


def bits_of(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Whether each cell's bit is set; the lowest bit of a byte is its first."""
    return (bits[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1
